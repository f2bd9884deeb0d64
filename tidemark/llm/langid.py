"""Language identification with unigram pieces, summing over all segmentations of a text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, sliced, staged, word_tokens

UNDETERMINED = "und"
WORD_START = "▁"
STEP = np.uint64(0x9E3779B97F4A7C15)
TABLE_BITS = 22
#: Probability of a character that no piece covers.
UNKNOWN = 1e-7
#: Words handled at once, and cells (words x characters) at most.
CHUNK_WORDS, CHUNK_CELLS = 16_384, 1 << 19
#: Expected uses in longer words are summed as logarithms, which cannot leave the range of doubles.
LONG_WORD_CHARS = 40
#: The fit counts longer words as runs of so many characters.
FIT_RUN_CHARS = 16_384


def read_pieces(path: str | None = None) -> list[str]:
    """Pieces of a public sentencepiece vocabulary, without control and byte pieces."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    skip = lambda i: model.is_control(i) or model.is_byte(i) or model.is_unknown(i)
    return [model.id_to_piece(i) for i in range(model.get_piece_size()) if not skip(i)]


class PieceIndex:
    """Finds which pieces start at every character of many words at once."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        h = np.fromiter((self._hash(p) for p in pieces), np.uint64, self.size)
        self.order = np.argsort(h)
        self.keys = h[self.order]
        self.seen = np.zeros(1 << TABLE_BITS, bool)
        self.seen[h >> np.uint64(64 - TABLE_BITS)] = True

    @staticmethod
    def _hash(piece: str) -> int:
        h = np.zeros(1, np.uint64)
        for c in piece:
            h = h * STEP + np.uint64(ord(c))
        return int(mixed(h)[0])

    def match(self, chars: np.ndarray) -> list[np.ndarray]:
        """For each length 1.., piece numbers by (word, start); ``size`` where there is none."""
        found, h = [], np.zeros(chars.shape, np.uint64)
        for n in range(1, min(self.longest, chars.shape[1]) + 1):
            h = h[:, : chars.shape[1] - n + 1] * STEP + chars[:, n - 1 :]
            full = mixed(h)
            hit = np.nonzero(self.seen[full >> np.uint64(64 - TABLE_BITS)])
            out = np.full(h.shape, self.size, np.int32)
            if len(hit[0]) and self.size:
                want = full[hit]
                at = np.minimum(np.searchsorted(self.keys, want), self.size - 1)
                out[hit] = np.where(self.keys[at] == want, self.order[at], self.size)
            found.append(out)
        return found


def chunks(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(numbers, code points padded with 0, lengths) of words of similar length; none of the words
    is cut."""
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 1
    order = np.argsort(lens, kind="stable")
    at = 0
    while at < len(order):
        end = at + 1
        stop = min(len(order), at + CHUNK_WORDS)
        limit = np.searchsorted(lens[order[at:stop]], max(2 * lens[order[at]], 16), side="right")
        while end < at + limit and (end - at + 1) * lens[order[end]] <= CHUNK_CELLS:
            end = min(at + limit, end + 256)
        some = order[at:end]
        size = lens[some]
        chars = np.zeros((len(some), size.max()), np.uint64)
        flat = np.frombuffer("".join(WORD_START + words[i] for i in some).encode("utf-32-le", "surrogatepass"), np.uint32)
        chars[np.arange(chars.shape[1]) < size[:, None]] = flat
        yield some, chars, size
        at = end


def _edges(index: PieceIndex, chars: np.ndarray) -> list[np.ndarray]:
    """Matches, where a character without a piece of its own becomes piece number size + 1."""
    found = index.match(chars)
    found[0] = np.where((found[0] == index.size) & (chars > 0), index.size + 1, found[0])
    return found


def padded(p: np.ndarray) -> np.ndarray:
    """Probabilities by piece and language, with rows for no piece (0) and an unknown character."""
    return np.vstack([p, np.zeros((1, p.shape[1])), np.full((1, p.shape[1]), UNKNOWN)])


def log_probabilities(index: PieceIndex, p: np.ndarray, words: list[str]) -> np.ndarray:
    """log P(word) by word and language: the forward sum over all segmentations into pieces."""
    table, out = padded(p), np.zeros((len(words), p.shape[1]))
    for some, chars, size in chunks(words):
        found, total = _edges(index, chars), chars.shape[1]
        keep = len(found)
        forward = {0: np.ones((len(some), p.shape[1]))}
        scale = np.zeros(len(some))
        for t in range(1, total + 1):
            now = np.zeros((len(some), p.shape[1]))
            for n in range(1, min(keep, t) + 1):
                now += forward[t - n] * table[found[n - 1][:, t - n]]
            forward[t] = now
            forward.pop(t - keep - 1, None)
            ended = size == t
            if ended.any():
                out[some[ended]] = np.log(np.maximum(now[ended], 1e-300)) + scale[ended, None]
            if t % 8 == 0 and t < total:  # keep long words within the range of doubles
                top = np.max([f.max(1) for f in forward.values()], axis=0)
                top[top <= 0] = 1
                for f in forward.values():
                    f /= top[:, None]
                scale += np.log(top)
    return out


def expected_counts(index: PieceIndex, p: np.ndarray, words: list[str], lang: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected uses of each piece by language, over all segmentations of the weighted words."""
    table, out = padded(p), np.zeros(p.size + 2 * p.shape[1])
    for some, chars, size in chunks(words):
        found, total, which = _edges(index, chars), chars.shape[1], lang[some]
        if total > LONG_WORD_CHARS:
            for f, use in _long_uses(table, found, size, which, weight[some]):
                hit = use > 0
                out += np.bincount((f * p.shape[1] + which[:, None])[hit], use[hit], len(out))
            continue
        cost = [table[f, which[:, None]] for f in found]
        a = np.zeros((total + 1, len(some)))
        a[0] = 1
        for t in range(1, total + 1):
            for n in range(1, min(len(found), t) + 1):
                a[t] += a[t - n] * cost[n - 1][:, t - n]
        b = np.zeros((total + 1, len(some)))
        for t in range(total, -1, -1):
            b[t][size == t] = 1
            for n in range(1, min(len(found), total - t) + 1):
                b[t] += b[t + n] * cost[n - 1][:, t]
        share = weight[some] / np.maximum(b[0], 1e-300)
        for n, f in enumerate(found, 1):
            use = a[: total - n + 1].T * cost[n - 1] * b[n:].T * share[:, None]
            hit = use > 0
            out += np.bincount((f * p.shape[1] + which[:, None])[hit], use[hit], len(out))
    return out[: p.size].reshape(p.shape)


def _long_uses(table: np.ndarray, found: list[np.ndarray], size: np.ndarray, which: np.ndarray, weight: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Matches and their expected uses by word and start, for each length of a piece."""
    total, keep, none = found[0].shape[1], len(found), -np.inf
    with np.errstate(divide="ignore"):
        logs = np.log(table)
    cost = np.full((keep, total + keep, len(which)), none)  # by length, start + keep, word
    for n, f in enumerate(found):
        cost[n, keep - 1 : keep - 1 + f.shape[1]] = logs[f, which[:, None]].T
    each = np.arange(keep)

    def summed(terms: np.ndarray) -> np.ndarray:
        top = terms.max(0)
        top = np.where(top == none, 0, top)
        with np.errstate(divide="ignore"):
            return np.log(np.exp(terms - top).sum(0)) + top

    a = np.full((total + keep, len(which)), none)  # from row keep - 1 on
    a[keep - 1] = 0
    for t in range(1, total + 1):
        at = keep - 1 + t - 1 - each
        a[keep - 1 + t] = summed(a[at] + cost[each, at])
    b = np.full((total + keep + 1, len(which)), none)
    for t in range(total, -1, -1):
        b[t] = np.where(size == t, 0, summed(b[t + 1 + each] + cost[each, keep - 1 + t]))
    for n, f in enumerate(found, 1):
        stop = total - n + 1
        yield f, (np.exp(a[keep - 1 : keep - 1 + stop] + cost[n - 1, keep - 1 : keep - 1 + stop] + b[n : n + stop] - b[0]) * weight).T


@dataclass
class Model:
    """Piece probabilities by language; its size is bounded by vocabulary times languages."""

    index: PieceIndex
    languages: list[str]
    p: np.ndarray


def has_letter(text: Column) -> Column:
    return F.coalesce(F.regexp_like(text, F.lit(r"\p{L}")), F.lit(False))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", pieces: list[str] | None = None, docs_per_language: int = 2_000, rounds: int = 3) -> Model:
    """Learn piece probabilities by expectation maximisation from labelled rows.

    The fit reads at most about ``docs_per_language`` documents of each language, chosen by a hash of
    ``key``; the bound is on this classifier's labelled rows only. All words of these count; one of more
    than ``FIT_RUN_CHARS`` characters counts as runs of that length. Rows without a language or without
    a letter are passed over. Languages are collected to the driver, so their number must be small.
    """
    index = PieceIndex(read_pieces() if pieces is None else pieces)
    rows = docs.where(F.col(lang).isNotNull() & has_letter(F.col(text))).select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"), F.xxhash64(F.col(key).cast("string")).alias("h"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    width = len(languages)
    p = np.full((index.size, max(width, 1)), 1.0 / max(index.size, 1))
    if not languages:
        return Model(index, languages, p)
    share = F.create_map(*[x for l in languages for x in (F.lit(l), F.lit(min(1.0, docs_per_language / sizes[l])))])
    some = rows.where(F.pmod(F.col("h"), F.lit(1_000_003)) < F.element_at(share, F.col("lang")) * 1_000_003)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, "text"):
                offsets, codes, words = word_tokens(batch.column("text"))
                tag = np.asarray([languages.index(l) for l in batch.column("lang").to_pylist()])
                both = np.repeat(tag, np.diff(offsets)) * len(words) + codes
                key, n = np.unique(both, return_counts=True)
                low = [words[i].decode("utf-8", "replace").lower() for i in (key % max(len(words), 1))]
                tags = key // max(len(words), 1)
                runs = np.fromiter((max(1, -(-len(w) // FIT_RUN_CHARS)) for w in low), np.int64, len(low))
                if (runs > 1).any():
                    low = [w[i : i + FIT_RUN_CHARS] for w in low for i in range(0, max(len(w), 1), FIT_RUN_CHARS)]
                    tags, n = np.repeat(tags, runs), np.repeat(n, runs)
                yield pa.RecordBatch.from_arrays([pa.array(low, pa.string()), pa.array(tags, pa.int32()), pa.array(n, pa.int64())], ["word", "tag", "n"])

    counted = some.select("text", "lang").mapInArrow(count, "word string, tag int, n bigint")
    words = staged(counted.groupBy("word", "tag").agg(F.sum("n").alias("n")))
    for _ in range(rounds):
        def expect(batches: Iterator[pa.RecordBatch], p=p) -> Iterator[pa.RecordBatch]:
            total = np.zeros(p.shape)
            for b in batches:
                total += expected_counts(index, p, b.column("word").to_pylist(), b.column("tag").to_numpy(), b.column("n").to_numpy().astype(float))
            piece, tag = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(tag, pa.int32()), pa.array(total[piece, tag])], ["piece", "tag", "n"])

        sums = words.mapInArrow(expect, "piece int, tag int, n double").groupBy("piece", "tag").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full(p.shape, 0.01)
        np.add.at(counts, (sums["piece"].to_numpy(), sums["tag"].to_numpy()), sums["n"].to_numpy())
        p = counts / counts.sum(0)
    return Model(index, languages, p)


def score_texts(model: Model, text: pa.Array) -> np.ndarray:
    """log P(text) by row and language."""
    offsets, codes, words = word_tokens(text)
    each = log_probabilities(model.index, model.p, [w.decode("utf-8", "replace").lower() for w in words])
    out = np.zeros((len(offsets) - 1, each.shape[1]))
    for k in range(each.shape[1]):
        sums = np.concatenate(([0.0], np.cumsum(each[codes, k])))
        out[:, k] = sums[offsets[1:]] - sums[offsets[:-1]]
    return out


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the share of the best language's likelihood).

    Only the text is read. Null texts and texts without a letter get ``und`` and score 0, and so does
    every text if no language was learnt. Ties go to the first language by code point. Whole texts
    are scored, however long. Columns of ``docs`` named like the new ones are replaced.
    """
    languages = model.languages

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def best(texts: pa.Array) -> pa.Array:
        names, scores = [], []
        known = pc.fill_null(pc.match_substring_regex(texts.cast(pa.string()), r"\p{L}"), False).to_numpy(zero_copy_only=False)
        for part in sliced(pa.RecordBatch.from_arrays([texts, pa.array(known)], ["text", "known"]), "text"):
            ok = part.column("known").to_numpy(zero_copy_only=False)
            if not languages:
                names += [UNDETERMINED] * len(ok)
                scores += [0.0] * len(ok)
                continue
            logs = score_texts(model, part.column("text"))
            top = logs.argmax(1)
            with np.errstate(under="ignore"):
                share = 1.0 / np.exp(logs - logs.max(1, keepdims=True)).sum(1)
            names += [languages[i] if k else UNDETERMINED for i, k in zip(top, ok)]
            scores += np.where(ok, share, 0.0).tolist()
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    # Not repeated below filters on its result, as the optimiser may do with a pure function.
    found = docs.withColumn("_identified_here", best.asNondeterministic()(F.col(text).cast("string")))
    return found.withColumns({"lang_pred": F.col("_identified_here.lang_pred"), "score": F.col("_identified_here.score")}).drop("_identified_here")
