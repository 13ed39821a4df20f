"""The second extractor: a model that is asked for twelve fields in one JSON object.

``second_extractor(send)`` is a column function for ``plans.pipeline.parse_documents``. It asks
through a function of the caller's, with a window of concurrent requests in each task, a
deadline, and new attempts where no answer or no JSON object comes. Rows keep their order;
a document that gets no usable answer gets none, and its own values stay.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ORDER, PATIENT, record
from .calls import windowed

# The fields asked for, by record.
PATIENT_KEYS = ("patient_fname", "patient_lname", "dob", "patient_sex", "medical_record_no")
ORDER_KEYS = ("order_date", "order_no", "episode_start_date", "episode_end_date", "start_of_care", "physician_name", "primary_diagnosis")


@dataclass(frozen=True)
class Mode:
    """Limits of one kind of asking. Fixed values."""

    prompt_chars: int
    tokens: int
    seconds: float
    tries: int


FAST, SLOW = Mode(4_000, 512, 45.0, 2), Mode(12_000, 1_024, 90.0, 3)


def prompt(text: str, mode: Mode = FAST) -> str:
    """What is asked about a text: its first ``prompt_chars`` characters, and the keys."""
    keys = json.dumps(dict.fromkeys((*PATIENT_KEYS, *ORDER_KEYS), ""), indent=4)
    return f"Read this medical document and fill in the fields below.\nAnswer with one JSON object and nothing else; leave a field empty if the document lacks it.\n\nDOCUMENT\n{text[: mode.prompt_chars]}\nEND OF DOCUMENT\n\n{keys}"


def answer_fields(reply: str) -> dict[str, str] | None:
    """The twelve fields of a reply's outermost JSON object, trimmed; None if it has no such object."""
    start, stop = reply.find("{"), reply.rfind("}")
    try:
        found = json.loads(reply[start : stop + 1]) if 0 <= start < stop else None
    except ValueError:
        return None
    if not isinstance(found, dict):
        return None
    plain = lambda v: str(v).strip() if isinstance(v, (str, int, float)) and not isinstance(v, bool) else ""
    return {k: plain(found.get(k)) for k in (*PATIENT_KEYS, *ORDER_KEYS)}


def second_extractor(send: Callable[[str, int, float], str], mode: Mode = FAST, window: int = 8) -> Callable[[Column], Column]:
    """A column function from text to struct(patient, order); null where there is no text or no usable answer.

    ``send(prompt, most tokens, seconds)`` returns the reply's text; what it raises counts as
    no answer. A request that does not come back in ``seconds`` an attempt is given up.
    """
    keys = (*PATIENT_KEYS, *ORDER_KEYS)
    kind = T.StructType([T.StructField("answered", T.BooleanType()), *(T.StructField(k, T.StringType()) for k in keys)])

    def ask(text):
        if text is None or not text.strip():
            return None
        for _ in range(mode.tries):
            try:
                found = answer_fields(send(prompt(text, mode), mode.tokens, mode.seconds))
            except Exception:  # noqa: BLE001  the caller's function may raise anything; its document has no answer then
                found = None
            if found is not None:
                return found
        return None

    @F.pandas_udf(kind)
    def fields(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts = [t if isinstance(t, str) else None for t in texts]
            found = [x for _, x in windowed(texts, ask, window, mode.seconds * mode.tries)]
            yield pd.DataFrame([(x is not None, *((x or {}).get(k, "") for k in keys)) for x in found], columns=kind.names)

    def column(text: Column) -> Column:
        x = fields(text)
        made = F.struct(record(PATIENT, {k: x[k] for k in PATIENT_KEYS}).alias("patient"), record(ORDER, {k: x[k] for k in ORDER_KEYS}).alias("order"))
        return F.when(x["answered"], made)

    return column
