"""Language ID by segmentation-marginalised unigrams.

The vocabulary is a public tokenizer's pieces, fixed. Each language has a probability
for each piece, and a word's probability is the sum over all ways to cut it into
pieces, by the forward algorithm. A text's score for a language is the product over its
words, of whatever length; the language of highest posterior wins.

Piece probabilities are learned by expectation-maximisation: word counts of every
language's training texts are re-weighted by forward and backward sums.
Training needs the counts of words only, from a bounded sample of labelled texts
(``sample_mb``), whole texts and all their words.
"""

from __future__ import annotations

import math
import os
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import choose, crc_mod, cut, digest_at, digest_limits, mix, size_caps, utf8

_U = np.uint64
_MARK = "▁"
#: Words up to so many bytes are read many at once, longer ones one by one.
AT_ONCE = 1024
#: Bytes of text sampled for each language at least, however many languages share the sample.
LEAST_BYTES = 128_000
DEFAULT_VOCABULARY = "piece_bpe_32k.model"


def vocabulary(path: str | None = None) -> list[str]:
    """Pieces of a SentencePiece file without control and byte pieces, in file order."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(DEFAULT_VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=os.fspath(path))
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class _Kept(dict):
    """Letters and the marks on them as they are, anything else a blank."""

    def __missing__(self, code: int) -> int:
        self[code] = code if unicodedata.category(chr(code))[0] in "LM" else 32
        return self[code]


_KEPT = _Kept()
_ASCII = bytes(c if chr(c).isalpha() and c < 128 else 32 for c in range(256))


def normalise(text: bytes) -> bytes:
    """Letters lower-cased with their marks, everything else a blank: what a language is told by."""
    if text.isascii():
        return text.lower().translate(_ASCII)
    t = text.decode("utf-8", "replace").lower().translate(_KEPT)
    return t.encode() if any(map(str.isalpha, t)) else b""


class Pieces:
    """Finds vocabulary pieces in many words at once; any single byte is a piece of last resort."""

    def __init__(self, pieces: list[str]):
        # words are letters behind a blank: pieces with anything else occur in none
        keep = sorted({p.encode() for p in (p.replace(_MARK, " ").lower() for p in pieces) if p and p == p[:1] + p[1:].translate(_KEPT).replace(" ", "") and p[:1].translate(_KEPT) == p[:1]})
        longest = self.longest = max(map(len, keep), default=1)
        self.of = {p: i for i, p in enumerate(keep)}
        self.size = len(keep)
        self.powers = np.array([pow(0x100000001B3, k, 1 << 64) for k in range(longest)], _U)
        codes = np.array([self._code(p) for p in keep], _U)
        order = np.argsort(codes)
        self.codes, self.ids = codes[order], order.astype(np.int32)
        # a bit table says at once that most spans are no piece
        self.table = np.zeros(1 << 20, bool)
        self.table[(self.codes >> _U(44)).astype(np.int64)] = True
        self.n = self.size + 256  # after the pieces, single bytes

    def _code(self, piece: bytes) -> int:
        x = np.array([sum((b + 1) * int(self.powers[k]) for k, b in enumerate(piece)) % (1 << 64)], _U) + _U(len(piece))
        return int(mix(x)[0])

    def find(self, words: np.ndarray) -> dict[tuple[int, int], np.ndarray]:
        """words: bytes (rows: words of one length) -> {(start, length): piece id of each row, -1 for none}."""
        n, width = words.shape
        out = {}
        wide = words.astype(_U) + _U(1)
        for s in range(width):
            acc = np.zeros(n, _U)
            for k in range(min(self.longest, width - s)):
                acc = acc + wide[:, s + k] * self.powers[k]
                code = mix(acc + _U(k + 1))
                maybe = np.flatnonzero(self.table[(code >> _U(44)).astype(np.int64)])
                if k == 0:
                    ids = (self.size + words[:, s].astype(np.int32)).astype(np.int32)
                elif not len(maybe):
                    continue
                else:
                    ids = np.full(n, -1, np.int32)
                if len(maybe):
                    at = np.minimum(np.searchsorted(self.codes, code[maybe]), len(self.codes) - 1)
                    hit = self.codes[at] == code[maybe]
                    ids[maybe[hit]] = self.ids[at[hit]]
                if k == 0 or (ids >= 0).any():
                    out[s, k + 1] = ids
        return out


def by_length(words: list[bytes]):
    """Positions and byte matrices of words of like length, filled up with zeros, and their lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    # exact lengths first, then classes a quarter apart
    width = np.where(size <= 24, size, np.ceil(24 * 1.25 ** np.ceil(np.log(np.maximum(size, 24) / 24) / math.log(1.25) - 1e-9))).astype(np.int64)
    order = np.argsort(width, kind="stable")
    for w in np.unique(width[size <= AT_ONCE]).tolist():
        at = order[np.searchsorted(width[order], w) : np.searchsorted(width[order], w, "right")]
        at = at[size[at] <= AT_ONCE]
        yield at, np.frombuffer(b"".join([words[i].ljust(w, b"\0") for i in at]), np.uint8).reshape(len(at), w), size[at]


def _forward(found: dict, n: int, width: int, prob: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """alpha[i] * exp(scale[i]): summed probability of all cuts of the first i bytes, a row a word, a column a language.

    Rows are scaled every eight bytes, so that long words do not vanish.
    """
    alpha, scale = np.zeros((width + 1, n, prob.shape[1])), np.zeros((width + 1, n, prob.shape[1]))
    alpha[0] = 1
    longest = max((k for _, k in found), default=1)
    for s in range(width):
        if s and s % 8 == 0:
            # what later steps read or add to takes the new scale
            most = np.maximum(alpha[s : s + longest].max(axis=0), 1e-300)
            alpha[s : s + longest] /= most
            scale[s:] += np.log(most)
        for k in range(1, min(longest, width - s) + 1):
            if (ids := found.get((s, k))) is not None:
                alpha[s + k] += alpha[s] * prob[ids]  # id -1 is the last row, which is zero
    return alpha, scale


def _long_word(word: bytes, pieces: Pieces, prob: np.ndarray) -> np.ndarray:
    """log probability of one word, whatever its length, in a window of the longest piece."""
    window, log = [np.ones(prob.shape[1])] + [np.zeros(prob.shape[1]) for _ in range(pieces.longest - 1)], np.zeros(prob.shape[1])
    for s in range(len(word)):
        now = window.pop(0)
        if s % 8 == 0:
            most = np.maximum(np.max([now, *window], axis=0), 1e-300)
            now, window, log = now / most, [x / most for x in window], log + np.log(most)
        window.append(np.zeros(prob.shape[1]))
        for k in range(1, min(pieces.longest, len(word) - s) + 1):
            if (i := pieces.of.get(word[s : s + k], pieces.size + word[s] if k == 1 else None)) is not None:
                window[k - 1] = window[k - 1] + now * prob[i]
    return np.log(np.maximum(window[0], 1e-300)) + log


class Model:
    """Piece probabilities of each language."""

    def __init__(self, pieces: Pieces, langs: list[str], prob: np.ndarray, prior: np.ndarray):
        self.pieces, self.langs, self.prior = pieces, langs, np.log(np.maximum(prior, 1e-12))
        self.prob = np.vstack([prob, np.zeros((1, len(langs)))])

    def word_scores(self, words: list[bytes]) -> np.ndarray:
        """log probability of each word under each language."""
        out = np.empty((len(words), len(self.langs)))
        for at, grid, size in by_length(words):
            step = max(1, 4_000_000 // (grid.shape[1] * max(len(self.langs), 1)))  # memory of the forward sums
            for part in range(0, len(at), step):
                rows, own = grid[part : part + step], size[part : part + step]
                alpha, scale = _forward(self.pieces.find(rows), len(rows), rows.shape[1], self.prob)
                last = np.arange(len(rows))
                out[at[part : part + step]] = np.log(np.maximum(alpha[own, last], 1e-300)) + scale[own, last]
        for i, w in enumerate(words):
            if len(w) > AT_ONCE:
                out[i] = _long_word(w, self.pieces, self.prob)
        return out


def cut_words(text: bytes) -> list[bytes]:
    """Words, a blank before each."""
    return [b" " + w for w in normalise(text).split()]


def in_parts(word: bytes) -> list[bytes]:
    """The word, one of more than ``AT_ONCE`` bytes in consecutive parts of up to so many, cut between characters."""
    out, at = [], 0
    while len(word) - at > AT_ONCE:
        stop = at + AT_ONCE
        while stop > at + 1 and word[stop] & 0xC0 == 0x80:
            stop -= 1
        out.append(word[at:stop])
        at = stop
    return [*out, word[at:]]


def train(counts: dict[str, dict[bytes, int]], docs: dict[str, int], pieces: Pieces, rounds: int = 8, smooth: float = 0.5) -> Model:
    """EM from word counts of each language; probabilities are smoothed by ``smooth`` a piece.

    All of every word teaches; a very long one does so in parts (``in_parts``).
    """
    langs = sorted(counts)
    words = sorted({w for c in counts.values() for w in c})
    weight = np.array([[counts[lang].get(w, 0) for lang in langs] for w in words], float).reshape(len(words), len(langs))
    parts = [in_parts(w) for w in words]
    words, weight = [p for some in parts for p in some], np.repeat(weight, [len(some) for some in parts], axis=0)
    prob = np.full((pieces.n, len(langs)), 1.0 / pieces.n)
    groups = [(at, pieces.find(grid), grid.shape[1], size) for at, grid, size in by_length(words)] if words else []
    for _ in range(rounds if langs and words else 0):
        table = np.vstack([prob, np.zeros((1, len(langs)))])
        expected = np.zeros((pieces.n + 1, len(langs)))
        for at, found, width, size in groups:
            alpha, scale = _forward(found, len(at), width, table)
            longest = max(k for _, k in found)
            # beta is relative to alpha's scale at the same byte, and 1 where the word ends
            beta, last = np.zeros_like(alpha), np.arange(len(at))
            whole = np.maximum(alpha[size, last], 1e-300)
            for s in range(width, -1, -1):
                beta[s][size == s] = 1 / whole[size == s]
                for k in range(1, min(longest, width - s) + 1):
                    if (ids := found.get((s, k))) is not None:
                        beta[s] += beta[s + k] * table[ids] * np.exp(scale[s] - scale[s + k])
            for (s, k), ids in found.items():
                share = alpha[s] * table[ids] * beta[s + k] * np.exp(scale[s] - scale[s + k]) * weight[at]
                for j in range(len(langs)):
                    expected[:, j] += np.bincount(np.where(ids < 0, pieces.n, ids), share[:, j], pieces.n + 1)
        prob = expected[:-1] + smooth
        prob /= prob.sum(0)
    total = sum(docs.values())
    return Model(pieces, langs, prob, np.array([docs[lang] / max(total, 1) for lang in langs]))


def word_counts(docs: DataFrame, text: str, lang: str, flush: int = 200_000) -> DataFrame:
    """lang, word, n over all rows: words are summed in each task before they travel."""

    def per_batch(batches):
        counts: dict = {}

        def out():
            keys = list(counts)
            return pa.RecordBatch.from_pydict({"lang": pa.array([k[0] for k in keys], pa.string()), "word": pa.array([k[1] for k in keys], pa.binary()), "n": pa.array([counts[k] for k in keys], pa.int64())})

        for t in batches:
            buf, off = utf8(t["text"])
            for i, lang in enumerate(t["lang"].to_pylist()):
                for w in cut_words(buf[off[i] : off[i + 1]].tobytes()):
                    counts[lang, w] = counts.get((lang, w), 0) + 1
                if len(counts) > flush:
                    yield out()
                    counts.clear()
        yield out()

    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    return rows.mapInArrow(per_batch, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", vocabulary_path: str | None = None, sample_mb: int = 4, doc_id: str = "doc_id") -> Model:
    """Model of the languages in ``docs``; rows with a null language or text teach nothing.

    It is fitted on a sample of whole texts, ``sample_mb`` MB over all languages, but
    ``LEAST_BYTES`` for each language at least, in the order of a digest of id and text. Very
    long texts are left out where a language has enough others (``shared.size_caps``); every
    language teaches by one text at least, however long its texts are.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    kind, size = F.col(lang).cast("string"), F.octet_length(F.col(text)).cast("long")
    langs = rows.select(kind).distinct().count()
    budget = max(sample_mb * 1_000_000 // max(langs, 1), LEAST_BYTES)
    at = digest_at(F.col(doc_id), F.col(text))
    slim = cut(rows.select(at.alias("_at"), kind.alias("_kind"), size.alias("_size")))
    caps = size_caps(slim, budget)
    limit, seen = digest_limits(slim, budget, caps)
    sample = rows.withColumn("_at", at).where((size <= choose(kind, caps, 0.0)) & (F.col("_at") < choose(kind, limit, 0.0))).dropDuplicates(["_at"]) if limit else rows.limit(0)
    pieces = Pieces(vocabulary(vocabulary_path))
    counts: dict[str, dict[bytes, int]] = {one: {} for one in seen}
    for r in word_counts(sample, text, lang).toArrow().to_pylist():
        counts[r["lang"]][bytes(r["word"])] = r["n"]
    return train(counts, seen, pieces)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", *extra: Column, cache: int = 400_000) -> DataFrame:
    """doc_id, lang_pred, score and ``extra`` columns for each row."""
    shared = {"model": model}

    def per_batch(batches):
        m: Model = shared["model"]
        known: dict[bytes, int] = {}
        table = np.zeros((0, len(m.langs)))
        for t in batches:
            buf, off = utf8(t["text"])
            pred, score = [], []
            for lo in range(0, len(off) - 1, 500):
                texts = [cut_words(buf[a:b].tobytes()) for a, b in zip(off[lo : lo + 500], off[lo + 1 : lo + 501])]
                new = list({w for words in texts for w in words if w not in known})
                if len(known) + len(new) > cache:
                    known, table = {}, table[:0]
                    new = list({w for words in texts for w in words})
                known.update(zip(new, range(len(table), len(table) + len(new))))
                if new and m.langs:
                    table = np.vstack([table, m.word_scores(new)])
                for words in texts:
                    if not words or not m.langs:
                        pred.append("und")
                        score.append(0.0)
                        continue
                    z = table[np.fromiter((known[w] for w in words), np.int64, len(words))].sum(0) + m.prior
                    z = np.exp(z - z.max())
                    k = int(z.argmax())
                    pred.append(m.langs[k])
                    score.append(float(z[k] / z.sum()))
            yield pa.RecordBatch.from_arrays([*(t.column(k) for k in range(t.num_columns) if t.schema.names[k] != "text"), pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[x for x in t.schema.names if x != "text"] + ["lang_pred", "score"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), *extra, F.col(text).cast("string").alias("text"))
    kinds = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes if n != "text")
    return rows.mapInArrow(per_batch, f"{kinds}, lang_pred string, score double")


def identify_languages(docs: DataFrame, held_out: Column | None = None, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", vocabulary_path: str | None = None, sample_mb: int = 4) -> DataFrame:
    """Columns doc_id, held_out, lang_pred, score for every row.

    ``held_out`` rows are not learned from (default: crc32 of the id modulo 4 is 2). The
    prediction sees the text alone. A text that is null or has no letter is ``und`` with
    score 0, and so is every text when nothing could be learned. The score is the
    posterior of the predicted language. Ties go to the first language by code point.
    Repeated rows are predicted one by one; an empty table gives an empty result.
    """
    held = F.coalesce(held_out if held_out is not None else crc_mod(doc_id, 4) == 2, F.lit(False))
    model = fit(docs.where(~held), text, lang, vocabulary_path, sample_mb=sample_mb, doc_id=doc_id)
    out = predict(docs, model, doc_id, text, held.alias("held_out"))
    return out.select("doc_id", "held_out", "lang_pred", "score")
