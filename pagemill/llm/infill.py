"""Fill-in-the-middle: a text's middle part moved behind its end, cut at token boundaries.

A token is a longest run of ASCII letters, or any other code point.  The bytes of a text are symbols of four classes:
bytes that go on with a code point, code points that aren't letters, first letters of a token, and further letters.  A
wavelet matrix over the symbols of many texts answers how often a class occurs before a byte.  Tokens before a byte are
the ranks of two classes together, code points the ranks of three.  Both cuts of all texts at once are found by bisection
on these ranks: the last byte with at most so many tokens before it.

Which texts stay plain, where the others are cut and in which order their parts stand is told by a hash of doc_id alone,
so that reruns agree.  The markers part the output again (``restored``): texts that hold one stay plain.

Defined cases: null and empty texts are plain and empty; a cut may leave a part empty; a null doc_id counts as an empty
one; repeated rows are treated alike; very long texts are cut whole (in memory: a text's bytes in a few forms); an empty
table gives no rows; other columns are left out, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of texts that are transformed, and of these the share whose suffix comes first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
#: Bytes of texts that are worked on together (a longer text alone).
TOGETHER = 1 << 23
#: Classes of a byte: inside a code point, a code point that's no letter, a token's first letter, a further letter.
INSIDE, OTHER, FIRST, FURTHER = range(4)
_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[[*range(65, 91), *range(97, 123)]] = True


class Bits:
    """Counts of set bits before a place, by counts before each 64 bits and the bits of one word."""

    def __init__(self, bits: np.ndarray):
        packed = np.zeros(len(bits) // 64 * 8 + 8, dtype=np.uint8)
        some = np.packbits(bits, bitorder="little")
        packed[: len(some)] = some
        self.words = packed.view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))


class WaveletMatrix:
    """Ranks of four symbols: the high bits in the text's order, then the low bits with those of low symbols first."""

    def __init__(self, symbols: np.ndarray):
        high = symbols >= 2
        self.high = Bits(high)
        self.n_low = len(symbols) - int(high.sum())
        self.low = Bits(np.concatenate([symbols[~high], symbols[high]]) & 1)

    def rank(self, symbol: int, at: np.ndarray) -> np.ndarray:
        """How many of the first ``at`` symbols are ``symbol``."""
        upper = self.high.ones(at)
        begin, end = (self.n_low, self.n_low + upper) if symbol >= 2 else (0, at - upper)
        ones = self.low.ones(end) - self.low.ones(np.array(begin))
        return ones if symbol & 1 else end - begin - ones

    def tokens(self, at: np.ndarray) -> np.ndarray:
        return self.rank(OTHER, at) + self.rank(FIRST, at)

    def chars(self, at: np.ndarray) -> np.ndarray:
        return at - self.rank(INSIDE, at)


def classes(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The class of each byte; texts begin at ``begins``."""
    letter = _IS_LETTER[data]
    out = np.where((data & 0xC0) == 0x80, INSIDE, OTHER).astype(np.uint8)
    goes_on = np.zeros(len(data), dtype=bool)
    goes_on[1:] = letter[:-1]
    goes_on[begins[begins < len(data)]] = False
    out[letter] = FIRST
    out[letter & goes_on] = FURTHER
    return out


def cut_at(m: WaveletMatrix, begin: np.ndarray, end: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """For each text [begin, end) the byte before which ``tokens`` whole tokens stand."""
    base, low, high = m.tokens(begin), begin.copy(), end.copy()
    while (low < high).any():
        half = (low + high + 1) // 2
        fits = m.tokens(half) - base <= tokens
        low, high = np.where(fits, half, low), np.where(fits, high, half - 1)
    return low


def cuts(data: np.ndarray, ends: np.ndarray, draws: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, ...]:
    """Of texts that lie one after the other in ``data``: tokens, both cuts (bytes from the text's begin), code points
    before the first cut and between the two.  ``draws``: two numbers, each modulo tokens + 1 a cut."""
    begin, end = ends[:-1], ends[1:]
    m = WaveletMatrix(classes(data, begin))
    n = m.tokens(end) - m.tokens(begin)
    one, two = draws[0] % (n + 1), draws[1] % (n + 1)
    first, second = cut_at(m, begin, end, np.minimum(one, two)), cut_at(m, begin, end, np.maximum(one, two))
    return n, first - begin, second - begin, m.chars(first) - m.chars(begin), m.chars(second) - m.chars(first)


def _transformed(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
    p, s, mid = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    for texts, plain, suffix_first, h1, h2 in batches:
        texts = pc.cast(pc.fill_null(texts, ""), pa.large_string())
        ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, dtype=np.int64)
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
        draws = h1.to_numpy(zero_copy_only=False), h2.to_numpy(zero_copy_only=False)
        plain, suffix_first = plain.to_pylist(), suffix_first.to_pylist()
        figures, outputs, at = [], [], 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + TOGETHER, side="right")) - 1)
            own = data[ends[at] : ends[to]]
            found = cuts(own, ends[at : to + 1] - ends[at], (draws[0][at:to], draws[1][at:to]))
            figures.append(found)
            for i in range(at, to):
                text = own[ends[i] - ends[at] : ends[i + 1] - ends[at]].tobytes()
                a, b = int(found[1][i - at]), int(found[2][i - at])
                if plain[i]:
                    outputs.append(text)
                elif suffix_first[i]:
                    outputs.append(b"".join((s, text[b:], p, text[:a], mid, text[a:b])))
                else:
                    outputs.append(b"".join((p, text[:a], s, text[b:], mid, text[a:b])))
            at = to
        n, _, _, before, between = (np.concatenate(x) for x in zip(*figures, strict=True)) if figures else (np.empty(0, dtype=np.int64),) * 5
        none = pa.array(np.array(plain, dtype=bool))
        chars = [pc.if_else(none, pa.scalar(None, pa.int64()), pa.array(x)) for x in (before, between)]
        yield pa.StructArray.from_arrays([pa.array(n), *chars, pc.cast(pa.array(outputs, pa.binary()), pa.string())], names=["n", "prefix_chars", "middle_chars", "output"])


def draws_of(doc_id: Column) -> list[Column]:
    """Four numbers of 32 bits for each document."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def infilled(docs: DataFrame, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """doc_id, n (tokens), form (plain, psm or spm), prefix_chars, middle_chars, output; ``transformed`` and
    ``suffix_first`` in percent."""
    h1, h2, h3, h4 = draws_of(F.col("doc_id"))
    text = F.coalesce("text", F.lit(""))
    holds = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = F.when((text == "") | holds | (h3 % 100 >= transformed), "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    cut = F.arrow_udf(_transformed, "n long, prefix_chars long, middle_chars long, output string")
    told = docs.select("doc_id", "text", form.alias("form"), h1.alias("h1"), h2.alias("h2"))
    return told.select("doc_id", "form", cut("text", F.col("form") == "plain", F.col("form") == "spm", "h1", "h2").alias("_cut")).select("doc_id", "_cut.n", "form", "_cut.prefix_chars", "_cut.middle_chars", "_cut.output")


def restored(form: Column, output: Column) -> Column:
    """The text that ``output`` was made of."""
    second, third = F.when(form == "psm", F.instr(output, SUFFIX)).otherwise(F.instr(output, PREFIX)), F.instr(output, MIDDLE)
    one, two, end = F.substring(output, F.lit(4), second - 4), F.substring(output, second + 3, third - second - 3), F.substring(output, third + 3, F.length(output))
    return F.when(form == "plain", output).when(form == "psm", F.concat(one, end, two)).otherwise(F.concat(two, end, one))


def infill_digest(docs: DataFrame) -> DataFrame:
    out = infilled(docs)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("form"), F.col("output"))).alias("restored_sha256"))
