"""Language-model scores by deleted interpolation.

The probability of a word after its context mixes maximum-likelihood estimates, from
trigrams (``order`` sets how long they get) down to single words and a uniform one. The
weights depend on how often the context was seen: on the bucket of the longest seen
context's count. They are learned by expectation-maximisation: counts are split into
retained and deleted ones, and the weights make the deleted words likeliest under
estimates from the retained counts alone. Scores then use all training counts.

Counts travel as tallies (see ``shared``): every group of documents asks the owner of
each key range for the counts of the keys that the group holds, once a key. No table
of counts is broadcast, and a word that makes up a third of the corpus is one key. A
group is a stretch of one input partition, so questions are asked where the texts are
read; texts move once, to meet the answers.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import Words, chunk_numbers, crc_mod, cut, dealt, mix, planes, settled, slices, trim, unplane

_U = np.uint64
_END = _U(0x2545F4914F6CDD1D)
_BOS = _U(0x9FB21C651E98DF25)
_STEP = 4  # cells of the held-out table to an octave of probability
_CELL = 10  # bits of a cell's number
COUNTS = 48  # buckets of counts by powers of two


def context_bucket(contexts: list[np.ndarray]) -> np.ndarray:
    """Row of weights for counts of the contexts of one word, two words, ...

    0 where none was seen, else by the longest that was seen and the power of two of its count.
    """
    row = np.zeros(len(contexts[0]) if contexts else 0, np.int64)
    for k, c in enumerate(contexts):
        row = np.where(c > 0, k * COUNTS + 1 + np.floor(np.log2(np.maximum(c, 1))).astype(np.int64), row)
    return row


def cell(p: np.ndarray) -> np.ndarray:
    """0 for no probability, else the number k that stands for 2 ** ((1 - k) / 4)."""
    return np.where(p > 0, 1 + np.rint(-_STEP * np.log2(np.where(p > 0, p, 1))), 0).astype(np.int64)


def learn_weights(events: np.ndarray, order: int, uniform: float, rounds: int = 60) -> np.ndarray:
    """EM over held-out events; one row of weights a bucket: of the longest n-gram, ..., the word, the uniform.

    ``events`` has rows (bucket, cells of the estimates from the longest on, count). A bucket
    without events takes the weights of the bucket below it, of contexts of the same length.
    """
    weights = np.zeros(((order - 1) * COUNTS + 1, order + 1))
    for row in range(len(weights)):
        longest = (row - 1) // COUNTS + 2 if row else 1
        able = np.arange(order, -1, -1) <= longest  # estimates that this context has
        own = events[events[:, 0] == row]
        if not len(own):
            first = row == 0 or (row - 1) % COUNTS == 0
            w = np.where(able, 0.5 ** np.arange(order + 1), 0) if first else weights[row - 1]
        else:
            p = np.where(own[:, 1:-1] > 0, 2.0 ** ((1 - own[:, 1:-1]) / _STEP), 0.0)
            p = np.concatenate([p, np.full((len(own), 1), uniform)], axis=1)
            w = able / able.sum()
            for _ in range(rounds):
                share = p * w
                share *= (own[:, -1] / share.sum(1))[:, None]
                w = share.sum(0) / share.sum()
            w = np.where(able, np.maximum(w, 1e-6), 0)
        weights[row] = w / w.sum()
    return weights


class _Group:
    """Words of one group of documents, with a closing token for each, and their n-grams."""

    def __init__(self, texts, order: int, width: int):
        words = Words(texts)
        n = words.counts + 1
        last = np.cumsum(n) - 1
        token = np.empty(int(n.sum()), _U)
        real = np.ones(len(token), bool)
        real[last] = False
        token[real], token[last] = words.hashes, _END
        self.n, self.firsts = n, last - n + 1
        self.keys, self.at = [], []
        gram = token
        for k in range(order):
            if k:
                before = np.empty_like(gram)
                before[1:] = gram[:-1]
                before[self.firsts] = _BOS
                gram = mix(before * _U(0x5851F42D4C957F2D) + token)
            # the upper bytes of an n-gram's hash are its key
            keys, at = np.unique(gram & ~_U((1 << (64 - 8 * width)) - 1) if k else gram, return_inverse=True)
            self.keys.append(keys)
            self.at.append(at)

    def contexts(self, counts: list[np.ndarray], docs: int) -> list[np.ndarray]:
        """Counts of the contexts of one word, two words, ... at each place."""
        out = []
        for n, at in zip(counts[:-1], self.at[:-1]):
            c = np.empty(len(at))
            c[1:] = n[at[:-1]]
            c[self.firsts] = docs  # the beginning of a text
            out.append(c)
        return out

    def estimates(self, counts: list[np.ndarray], contexts: list[np.ndarray], tokens: int) -> list[np.ndarray]:
        """Maximum-likelihood estimates from the longest n-gram to the word."""
        at = [n[a] for n, a in zip(counts, self.at)]
        return [np.where(c > 0, n / np.maximum(c, 1), 0) for n, c in zip(at[:0:-1], contexts[::-1])] + [at[0] / max(tokens, 1)]


def _bytes_for(n: np.ndarray) -> int:
    return max(1, -(-int(n.max() if len(n) else 0).bit_length() // 8))


def _pack(*fields: tuple[np.ndarray, int]) -> bytes:
    return bytes(w for _, w in fields) + b"".join(planes(x.astype(_U), w) for x, w in fields)


def _unpack(blob: bytes, fields: int) -> list[np.ndarray]:
    widths, out = list(blob[:fields]), []
    n, at = (len(blob) - fields) // max(sum(widths), 1), fields
    for w in widths:
        out.append(unplane(blob[at : at + n * w], w))
        at += n * w
    return out


def _grouped(size: int):
    """Batches with the number p of each row's group; those of deleted documents are odd."""

    def grouped(batches):
        first, before = TaskContext.get().partitionId() << 32, 0
        for t in batches:
            chunk, before = chunk_numbers(t["text"], before, size)
            p = pa.array((first + chunk) * 2 + np.asarray(t["gone"]))
            yield pa.RecordBatch.from_arrays([p, t["doc_id"], t["held_out"], t["text"]], names=["p", "doc_id", "held_out", "text"])

    return grouped


def _ask(size: int, buckets: int, order: int, width: int):
    """Each group's distinct words and n-grams, and how often it holds them in training."""

    def tally(p: int, table: pa.Table) -> pa.RecordBatch:
        g = _Group(table["text"], order, width)
        train = np.repeat(~np.asarray(table["held_out"]), g.n).astype(float)
        out: list[dict[int, bytes]] = []
        for k, (keys, at) in enumerate(zip(g.keys, g.at)):
            n, w = np.bincount(at, train, len(keys)).astype(_U), width if k else 8
            out.append({b: _pack((keys[s] >> _U(64 - 8 * w), w), (n[s], _bytes_for(n[s]))) for b, s in slices(keys, buckets)})
        own = sorted(set().union(*out))
        return pa.RecordBatch.from_pydict({"bucket": pa.array(own, pa.int32()), "p": pa.array([p] * len(own), pa.int64()), **{f"g{k}": pa.array([v.get(b) for b in own], pa.binary()) for k, v in enumerate(out)}})

    def ask(batches):
        held: dict[int, list] = {}
        for t in _grouped(size)(batches):
            p = np.asarray(t["p"])
            for one in np.unique(p).tolist():
                held.setdefault(one, []).append(t.filter(pa.array(p == one)))
            for done in [k for k in held if k // 2 < int(p[-1]) // 2] if len(p) else ():  # chunks follow one another
                yield tally(done, pa.Table.from_batches(held.pop(done)))
        for p in list(held):
            yield tally(p, pa.Table.from_batches(held.pop(p)))
        trim()

    return ask


def _sums(blobs: list, deleted: np.ndarray):
    """For every blob the bucket's retained and deleted counts of its keys; the distinct keys' counts."""
    parts = [_unpack(x, 2) if x else [np.zeros(0, _U)] * 2 for x in blobs]
    sizes = np.array([len(k) for k, _ in parts], np.int64)
    keys, n = (np.concatenate([x[i] for x in parts] or [np.zeros(0, _U)]) for i in range(2))
    late = np.repeat(deleted, sizes)
    distinct, at = np.unique(keys, return_inverse=True)
    kept = np.bincount(at, np.where(late, 0, n).astype(float), len(distinct))
    gone = np.bincount(at, np.where(late, n, 0).astype(float), len(distinct))
    told = [_pack(*((x[a], _bytes_for(x[a])) for x in (kept, gone))) if len(a) else None for a in np.split(at, np.cumsum(sizes)[:-1])]
    return told, kept, gone


def _answer(order: int):
    def answer(table: pa.Table) -> pa.Table:
        p, told = np.asarray(table["p"]), {}
        for k in range(order):
            told[f"g{k}"], kept, gone = _sums(table[f"g{k}"].to_pylist(), p % 2 == 1)
            if not k:
                total = kept + gone
                facts = {"tokens": int(total.sum()), "types": int((total > 0).sum()), "kept_tokens": int(kept.sum())}
        trim()
        n = len(p)
        return pa.table({
            "p": pa.array([*p, -2], pa.int64()), "bucket": pa.array([*table["bucket"].to_pylist(), table["bucket"][0].as_py()], pa.int32()),
            **{k: pa.array([*v, None], pa.binary()) for k, v in told.items()},
            **{k: pa.array([0] * n + [v], pa.int64()) for k, v in facts.items()},
        })

    return answer


def _counts(table: pa.Table, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Retained and deleted counts of a group's keys, from the word on."""
    table = table.sort_by("bucket")
    out = []
    for k in range(order):
        parts = [_unpack(x, 2) for x in table[f"g{k}"].to_pylist() if x]
        out.append(tuple(np.concatenate([x[i] for x in parts] or [np.zeros(0, _U)]).astype(float) for i in range(2)))
    return out


def _events(kept_tokens: int, kept_docs: int, order: int, width: int):
    """Held-out events of a group of deleted documents as a table of bounded size."""

    def events(key, docs: pa.Table, counts: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({k: pa.array([], pa.int64()) for k in ("event", "n")})
        g = _Group(docs["text"], order, width)
        kept = [x for x, _ in _counts(counts, order)]
        contexts = g.contexts(kept, kept_docs)
        code = context_bucket(contexts) if contexts else np.zeros(len(g.at[0]), np.int64)
        for p in g.estimates(kept, contexts, kept_tokens):
            code = (code << _CELL) | cell(p)
        code, n = np.unique(code, return_counts=True)
        return pa.table({"event": code, "n": n.astype(np.int64)})

    return events


def _score(weights: np.ndarray, tokens: int, types: int, train_docs: int, order: int, width: int):
    def score(key, docs: pa.Table, counts: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.table({"doc_id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})
        g = _Group(docs["text"], order, width)
        every = [x + y for x, y in _counts(counts, order)]
        contexts = g.contexts(every, train_docs)
        w = weights[context_bucket(contexts) if contexts else np.zeros(len(g.at[0]), np.int64)]
        p = w[:, -1] / (types + 1)
        for k, estimate in enumerate(g.estimates(every, contexts, tokens)):
            p = p + w[:, k] * estimate
        now = every[0][g.at[0]]
        base = np.log10((now + 0.1) / (tokens + 0.1 * (types + 1)))
        sums = lambda x: np.add.reduceat(x, g.firsts)
        out = pa.table({"doc_id": docs["doc_id"], "held_out": docs["held_out"], "n_tokens": pa.array(g.n.astype(np.int64)), "n_known": pa.array(sums((now > 0).astype(np.int64))), "base_score": pa.array(sums(base)), "score": pa.array(sums(np.log10(p)))})
        del g, every, contexts, w, p
        trim()
        return out

    return score


def score_documents(docs: DataFrame, held_out: Column | None = None, deleted: Column | None = None, doc_id: str = "doc_id", text: str = "text", order: int = 3, group_mb: int = 8, least_groups: int = 64) -> DataFrame:
    """log10 probability of every text under a model of the texts not held out.

    ``held_out`` marks rows that the model must not learn from (default: crc32 of the
    id modulo 10 is 0), ``deleted`` the training rows whose counts teach the mixture
    weights (default: the remainder is 1). Words are lower-cased in A-Z; each text ends
    with one closing token. ``base_score`` is add-0.1 unigram smoothing. ``order`` is
    the length of the longest n-grams, 5 at most.

    Null texts count as empty ones: a closing token alone. A null id counts as the
    empty text for the remainder. Repeated rows are scored, and counted, one by one, and
    rows are grouped where they are read, whatever their ids. Other columns are ignored.
    Without deleted rows fixed weights hold; an empty table gives an empty result. Words
    are told apart by 64-bit hashes, longer n-grams by so many bytes of theirs that one in
    some thousands is mistaken for another at most.
    """
    remainder = crc_mod(doc_id, 10)
    held = F.coalesce(held_out if held_out is not None else remainder == 0, F.lit(False))
    gone = F.coalesce(deleted if deleted is not None else remainder == 1, F.lit(False)) & ~held
    docs = settled(docs, spread=True)  # rows keep their groups
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    groups = max(least_groups, -(-size // (group_mb << 20)))
    width = min(8, max(5, -(-(size.bit_length() + 11) // 8)))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), held.alias("held_out"), gone.alias("gone"), F.col(text).cast("string").alias("text"))
    size = max(1, min(group_mb << 20, size // least_groups))

    grams = ", ".join(f"g{k} binary" for k in range(order))
    asked = dealt(rows.mapInArrow(_ask(size, groups, order, width), f"bucket int, p long, {grams}"), "bucket", groups)
    answers = cut(asked.groupBy("bucket").applyInArrow(_answer(order), f"p long, bucket int, {grams}, tokens long, types long, kept_tokens long"))
    rows = rows.mapInArrow(_grouped(size), "p long, doc_id long, held_out boolean, text string")
    n = answers.where("p < 0").agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(x) for x in ("tokens", "types", "kept_tokens"))).first()
    in_docs = docs.agg(F.count_if(~held).alias("train"), F.count_if(~held & ~gone).alias("kept")).first()
    for_group = answers.where("p >= 0").select("p", "bucket", *(f"g{k}" for k in range(order)))
    by_group = lambda df: df.groupBy("p")

    late = F.col("p") % 2 == 1
    events = by_group(rows.where(late)).cogroup(by_group(for_group.where(late))).applyInArrow(_events(n.kept_tokens, in_docs.kept, order, width), "event long, n long")
    table = events.groupBy("event").agg(F.sum("n").alias("n")).toArrow()
    code = table["event"].to_numpy().astype(np.int64)
    cells = [(code >> (_CELL * k)) & ((1 << _CELL) - 1) for k in range(order - 1, -1, -1)]
    weights = learn_weights(np.stack([code >> (_CELL * order), *cells, table["n"].to_numpy().astype(np.int64)], axis=1), order, 1.0 / (n.types + 1))

    scored = by_group(dealt(rows, "p", groups)).cogroup(by_group(dealt(for_group, "p", groups))).applyInArrow(_score(weights, n.tokens, n.types, in_docs.train, order, width), "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def perplexity(log10: float, tokens: int) -> float:
    return math.pow(10, -log10 / max(tokens, 1))
