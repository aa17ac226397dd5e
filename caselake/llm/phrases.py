"""Phrases whose words stand together more often than chance has it, level by level.

Words are counted first; a level of k words then counts only those places whose
two overlapping phrases of k - 1 words are frequent.  Those go out to all tasks as
hashes, as long as they are few, and else as a bitmap of fixed size.  Either may
let a rare phrase pass, which the exact count then drops, and neither loses one.
What is counted are the phrases themselves, gathered within each batch first.
Cuts of a phrase are scored from the tables of the shorter levels by joins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import staged, table, unstage
from .words import Words, grams, slices

#: Frequent phrases that go out as 8-byte hashes; beyond, a bitmap of so many bits does.
MOST_HASHES, BITMAP_BITS = 1 << 20, 1 << 26
#: Bytes of a text that a task looks at together, and parts that a language's first phrases are found in.
TEXT_BYTES, TOP_PARTS = 1 << 20, 32

#: Bytes that end a word, and those of them that end a piece too.
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?"]] = _ENDS[0x0A:0x0E] = True
_WORDS = (~_ENDS).astype(np.uint8)
_WORDS[[0x20, 0x09]] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Frequent:
    """Which hashes are those of frequent phrases: exactly that set of hashes, or a bitmap of them."""

    def __init__(self, hashes: np.ndarray | None = None, bits: np.ndarray | None = None) -> None:
        self.hashes, self.bits = None if hashes is None else np.sort(hashes), bits

    def has(self, h: np.ndarray) -> np.ndarray:
        if self.bits is not None:
            at = h & np.uint64(len(self.bits) * 8 - 1)
            return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        if not len(self.hashes):
            return np.zeros(len(h), bool)
        at = np.searchsorted(self.hashes, h)
        return self.hashes[np.minimum(at, len(self.hashes) - 1)] == h


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _dictionary(w: Words, used: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """The number of each of the words ``used`` among the different ones, and these."""
    start, size = w.start[used], (w.end - w.start)[used]
    ends = np.cumsum(size)
    data = w.data[np.arange(ends[-1]) + np.repeat(start - (ends - size), size)]
    offsets = np.concatenate(([0], ends)).astype(np.int64)
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _hashes(words: pa.Array) -> np.ndarray:
    """Hashes of single words, which may hold any bytes."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] else np.zeros(0, np.uint8)
    w = Words(pa.array([], pa.large_string()))
    w.data, w.start, w.end, w.outside = data[: offsets[-1]], offsets[:-1], offsets[1:], np.zeros(offsets[-1], bool)
    return w.hashes()


def _phrases(words: pa.Array, ids: np.ndarray) -> pa.Array:
    """Rows of word numbers as words with a space between."""
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)
    start, size = offsets[ids], np.diff(offsets)[ids]
    size[:, :-1] += 1  # and the space after it
    ends = np.cumsum(size.ravel())
    at = np.arange(ends[-1]) - np.repeat(ends - size.ravel(), size.ravel()) + np.repeat(start.ravel(), size.ravel())
    out = data[np.minimum(at, len(data) - 1)]
    out[(ends.reshape(size.shape)[:, :-1] - 1).ravel()] = 0x20
    bounds = np.concatenate(([0], ends.reshape(size.shape)[:, -1])).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(bounds), pa.py_buffer(out))


def _counted(text: pa.Array, lang: np.ndarray, lang_hash: np.ndarray, k: int, frequent: Frequent | None) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """Language numbers, phrases of ``k`` words and how often each occurs in the rows of ``text``."""
    w = Words(text, classes=_WORDS)
    if len(w.start) < k:
        return
    w.data = _LOWER[w.data]
    row = w.row_of_word()
    # words of one piece have one number: rows and the signs before them, counted together
    piece = np.searchsorted(np.flatnonzero(_ENDS[w.data]), w.start) + row
    at = np.flatnonzero(piece[: len(piece) - k + 1] == piece[k - 1 :])
    if k > 1:
        there = frequent.has(grams(w.hashes(), k - 1) ^ lang_hash[lang[row]])
        at = at[there[at] & there[at + 1]]
    if not len(at):
        return
    used = np.zeros(len(row), bool)
    for j in range(k):
        used[at + j] = True
    used = np.flatnonzero(used)
    word, words = _dictionary(w, used)
    own, at = lang[row[at]].astype(np.int64), np.searchsorted(used, at)
    # numbers of phrases from the left, each the number of the shorter one and the next word's: exact
    n = len(words)
    number, width = own * n + word[at], (int(lang.max()) + 1) * n
    for j in range(1, k):
        if width > (1 << 62) // n:
            number = np.unique(number, return_inverse=True)[1]
            width = len(at)
        number, width = number * n + word[at + j], width * n
    _, first, times = np.unique(number, return_index=True, return_counts=True)
    yield own[first], _phrases(words, word[at[first][:, None] + np.arange(k)]), times


def _pieces(text: str | bytes, k: int) -> Iterator[bytes]:
    """A long text in parts of bounded size, in which each run of ``k`` words of the text stands once.

    A part ends where a word does and begins with the last k - 1 words of the one before.
    """
    data = text.encode() if isinstance(text, str) else text
    whole = np.frombuffer(data, np.uint8)
    begin, end = 0, 0
    while end < len(whole):
        end = min(len(whole), end + TEXT_BYTES)
        while end < len(whole) and _WORDS[whole[end]]:
            near = np.flatnonzero(_WORDS[whole[end : end + 4096]] == 0)
            end = end + int(near[0]) if len(near) else min(len(whole), end + 4096)
        yield data[begin:end]
        if k > 1:  # go back over k - 1 words
            reach, starts = 4096, np.zeros(0, np.int64)
            while True:
                low = max(begin, end - reach)
                inside = _WORDS[whole[low:end]] == 1
                before = np.concatenate(([low > 0 and bool(_WORDS[whole[low - 1]])], inside[:-1]))
                starts = np.flatnonzero(inside & ~before) + low
                if len(starts) >= k - 1 or low == begin:
                    break
                reach *= 4
            begin = int(starts[max(0, len(starts) - (k - 1))]) if len(starts) else end
        else:
            begin = end


def level(docs: DataFrame, k: int, frequent: Frequent | None = None) -> DataFrame:
    """lang, phrase and f of the phrases of ``k`` words, all of them or, given ``frequent`` ones of k - 1 words, those that may be frequent.

    With one word, a row without phrase has the count of all words of a language.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            coded = b.column(0).dictionary_encode()
            lang, langs = coded.indices.to_numpy(), coded.dictionary
            lang_hash = np.array([_lang_hash(x) for x in langs.to_pylist()], np.uint64)
            text = b.column(1).cast(pa.large_string())
            for s, e in slices(text, TEXT_BYTES):
                parts = text.slice(s, e - s), lang[s:e]
                if e - s == 1 and pc.binary_length(parts[0])[0].as_py() > TEXT_BYTES:
                    several = ((pa.array([p], pa.large_binary()).cast(pa.large_string()), parts[1]) for p in _pieces(parts[0][0].as_py(), k))
                else:
                    several = (parts,)
                for some, own in several:
                    for at, phrase, times in _counted(some, own, lang_hash, k, shared.value):
                        yield pa.RecordBatch.from_arrays([langs.take(pa.array(at)), phrase.cast(pa.string()), pa.array(times)], ["lang", "phrase", "f"])
                        if k == 1:
                            total = np.bincount(at, weights=times, minlength=len(langs)).astype(np.int64)
                            yield pa.RecordBatch.from_arrays([langs, pa.nulls(len(langs), pa.string()), pa.array(total)], ["lang", "phrase", "f"])

    return docs.select("lang", "text").mapInArrow(count, "lang string, phrase string, f bigint").groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _hash_column(rows: DataFrame) -> DataFrame:
    """h: the hash of each phrase, as tasks work it out from a text."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                split = pc.split_pattern(b.column(1).cast(pa.large_string()), " ")
                k = len(split[0])
                own = _hashes(split.flatten().cast(pa.large_binary())).reshape(-1, k)
                lang = np.array([_lang_hash(x) for x in b.column(0).to_pylist()], np.uint64)
                h = grams(own.ravel(), k)[:: k] ^ lang
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    return rows.select("lang", "phrase").mapInArrow(hashed, "h bigint")


def frequent_phrases(rows: DataFrame) -> Frequent:
    """What goes out to all tasks: 8 bytes for each of ``rows`` (lang, phrase) up to ``MOST_HASHES``, else a bitmap of ``BITMAP_BITS``."""
    h = _hash_column(rows)
    if rows.limit(MOST_HASHES + 1).count() <= MOST_HASHES:
        return Frequent(hashes=h.toArrow().column(0).to_numpy().view(np.uint64))
    # a row for each 64 bits that are not all zero
    at = F.col("h").bitwiseAND(F.lit(BITMAP_BITS - 1))
    words = h.select(F.shiftright(at, 6).alias("word"), F.expr(f"shiftleft(1L, cast((h & {BITMAP_BITS - 1}) & 63 AS INT))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(BITMAP_BITS // 64, np.int64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return Frequent(bits=bits.view(np.uint8))


def _part(first: str, size: str) -> str:
    return f"array_join(slice(words, {first}, {size}), ' ')"


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, most: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``most`` best phrases of 2 to ``longest`` words of each language.

    ``docs`` has lang and text; other columns are not read, and every row counts,
    repeated ones too.  A null lang is ``und``, a null text empty.  A-Z are
    lower-cased; texts are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at
    blanks and tabs into words.  n counts the words of a language, a the
    occurrences of the phrase, which are ``least`` at least, l and r those of the
    two parts of its worst cut: the score is floor(1000 * a * n / (l * r)), the
    lowest counts, of equal ones the shortest left part.  Phrases inside a longer
    one that occurs as often go.  Ties of a score go to the larger a, then to the
    phrase that comes first by its bytes.  Counts are 64-bit; products have 38
    digits.  Without frequent phrases the result is empty.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    levels = [staged(level(rows, 1).filter((F.col("f") >= least) | F.col("phrase").isNull()), "words")]
    total = levels[0].filter("phrase IS NULL").select("lang", F.col("f").alias("n"))
    known = levels[0].filter("phrase IS NOT NULL")
    parts = known
    for k in range(2, longest + 1):
        frequent = frequent_phrases(known)
        known = staged(level(rows, k, frequent).filter(F.col("f") >= least), f"phrases{k}")
        levels.append(known)
        if k < longest:
            parts = parts.unionByName(known)
        if known.isEmpty():
            break
    found = levels[1].withColumn("k", F.lit(2))
    for k, more in enumerate(levels[2:], 3):
        found = found.unionByName(more.withColumn("k", F.lit(k)))
    found = found.withColumn("words", F.split("phrase", " "))
    # a phrase inside a longer one that occurs as often is inside one of a single word more that does
    inner = found.filter("k > 2").select("lang", F.col("f").alias("_f"), F.explode(F.array(F.expr(_part("1", "k - 1")), F.expr(_part("2", "k - 1")))).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("_f").alias("_f"))
    free = found.join(longer, ["lang", "phrase"], "left").filter("_f IS NULL OR 100 * _f < 100 * f").drop("_f")
    cuts = free.select("lang", "phrase", F.col("f").alias("a"), "k", "words", F.explode(F.expr("sequence(1, k - 1)")).alias("cut"))
    cuts = staged(cuts.select("lang", "phrase", "a", "cut", F.expr(_part("1", "cut")).alias("left"), F.expr(_part("cut + 1", "k - cut")).alias("right")), "cuts")
    part = lambda side, f: parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(f))
    both = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"]).join(F.broadcast(total) if total.limit(10_001).count() <= 10_000 else total, "lang")
    score = F.expr("CAST(1000 AS DECIMAL(4,0)) * a * n div (CAST(l AS DECIMAL(19,0)) * CAST(r AS DECIMAL(19,0)))")
    worst = both.withColumn("score", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    flat = worst.select("lang", "phrase", "a", "w.l", "w.r", "n", "w.score")
    by = [F.desc("score"), F.desc("a"), F.col("phrase")]
    flat = flat.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(TOP_PARTS)))
    flat = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*by))).filter(F.col("rank") <= most)
    ranked = flat.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by))).filter(F.col("rank") <= most)
    out = staged(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "collocations")
    for t in [*levels, cuts]:
        unstage(t)
    return out


OP12_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
f AS MATERIALIZED (
  SELECT lang, k::INT AS k, phrase, count(*) AS f
  FROM (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(list_slice(w, i, i + k - 1), ' '))) AS phrase FROM w, range(1, 6) AS t(k) WHERE len(w) >= k)
  GROUP BY lang, k, phrase HAVING count(*) >= 100),
inside AS (
  SELECT c.lang, c.phrase FROM f AS c JOIN f AS b ON c.lang = b.lang AND b.k > c.k AND 100 * b.f >= 100 * c.f AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' ')
  WHERE c.k >= 2),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, j, array_to_string(list_slice(string_split(c.phrase, ' '), 1, j), ' ') AS lp, array_to_string(list_slice(string_split(c.phrase, ' '), j + 1, c.k), ' ') AS rp
  FROM (SELECT * FROM f WHERE k >= 2) AS c ANTI JOIN inside USING (lang, phrase), range(1, 5) AS t(j) WHERE j < c.k),
scored AS (
  SELECT c.lang, c.phrase, a, x.f AS l, y.f AS r, n, j, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts AS c JOIN f AS x ON x.lang = c.lang AND x.phrase = lp JOIN f AS y ON y.lang = c.lang AND y.phrase = rp JOIN n ON n.lang = c.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, (row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase))::INT AS rank, phrase, a, l, r, n, score FROM worst QUALIFY rank <= 2000"""


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language of all documents."""
    return collocations(table(spark, sf_dir, "documents"))
