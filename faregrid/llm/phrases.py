"""Phrases that occur more often than their parts explain, mined level by level.

Words are counted per language first. A phrase can only be frequent if all shorter phrases
in it are. Frequent words, and then frequent pairs, are marked in a bitmap of a fixed size,
by hash; a chance hit only lets a phrase through that is counted for nothing. Pairs seen in
the texts whose words are marked, and phrases of three to five words whose pairs are all
marked, are candidates; those below the threshold are left out by sums over the shuffle.

The counts of the result come from one more pass: all candidates, of one to five words,
stand in double-array tries of at most ``TRIE`` phrases each, and every trie is broadcast
for a pass of its own (the number of passes grows with the candidates, a broadcast does
not). All positions of a batch of texts start at the root and step to their next word
together, level by level; the accepting states of all levels are counted and the counts of
the tasks summed.

Defined results: null and empty texts have no words; a null ``lang`` is ``und``; only A-Z are
lower-cased; repeated rows count each. An empty table gives an empty result. Scores are
exact while 1000 * a * n stays below 10**38.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faregrid.llm.doublearray import DoubleArray, nodes_of, pack
from faregrid.llm.ship import ship
from faregrid.session import staged

FREQUENT = 100
LONGEST = 5
FIRST = 2000
TRIE = 1 << 18
BITS = 1 << 24
PART = 1 << 15  # bits of one piece of the bitmap, as bitmap_construct_agg makes them
BATCH = 1 << 23  # bytes of texts that are cut into words together
BLOCK = 1 << 12  # counts that travel together
HELD = 1 << 17  # counts a task holds before it hands them on

UND = "und"
_BREAK = b"."  # in no word
_FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t,;:!?\x0a\x0b\x0c\x0d", b"abcdefghijklmnopqrstuvwxyz " + b"." * 9
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.DictionaryArray]]:
    """Language and words, in order and with a break between pieces, of texts put together."""
    for batch in batches:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
            raw = text.as_py()
            if not raw:
                continue
            held.setdefault(lang, []).append(raw.translate(_FOLD))
            size[lang] = size.get(lang, 0) + len(raw)
            if size[lang] >= BATCH:
                yield lang, _cut(held.pop(lang))
                size[lang] = 0
        for lang, texts in held.items():
            yield lang, _cut(texts)


def _cut(texts: list[bytes]) -> pa.DictionaryArray:
    whole = pa.array([b".".join(texts).replace(b".", b" . ").strip()], pa.large_binary())
    words = pc.ascii_split_whitespace(whole.cast(pa.large_string())).flatten().dictionary_encode()
    return pa.DictionaryArray.from_arrays(words.indices, words.dictionary.cast(pa.binary()))


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UND))
    return docs.select(lang.alias("lang"), F.col("text").cast("string").alias("text"))


def _rows(lang: str, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    langs = pa.array([lang] * len(n), pa.string())
    return pa.RecordBatch.from_arrays(
        [langs, phrases.cast(pa.string()), pa.array(n, pa.int64())], ["lang", "phrase", "n"]
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``phrase`` (one word) and ``n`` of all words."""

    def flushed(lang: str, found: dict[bytes, int]) -> pa.RecordBatch:
        return _rows(lang, pa.array(list(found), pa.binary()), np.fromiter(found.values(), np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, dict[bytes, int]] = {}
        for lang, words in _batches(batches):
            counts = np.bincount(words.indices.to_numpy(), minlength=len(words.dictionary))
            own = held.setdefault(lang, {})
            for word, n in zip(words.dictionary.to_pylist(), counts.tolist(), strict=True):
                own[word] = own.get(word, 0) + n
            own.pop(_BREAK, None)
            if len(own) >= HELD:
                yield flushed(lang, held.pop(lang))
        for lang, own in held.items():
            yield flushed(lang, own)

    return (
        _texts(docs)
        .mapInArrow(run, "lang string, phrase string, n bigint")
        .groupBy("lang", "phrase")
        .agg(F.sum("n").alias("n"))
    )


def _lang_mark(lang: str) -> int:
    return zlib.crc32(lang.encode() + b" ")


def _word_marks(words: pa.DictionaryArray, lang: str) -> np.ndarray:
    """A 64-bit mark of every position; 0 at breaks."""
    start = _lang_mark(lang)
    of = words.dictionary.to_pylist()
    marks = np.fromiter((zlib.crc32(w, start) for w in of), np.uint64, len(of)) + np.uint64(1)
    marks *= _MIX
    marks[np.fromiter((w == _BREAK for w in of), bool, len(of))] = 0
    return marks[words.indices.to_numpy()]


def _phrase_marks(marks: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Bitmap places of the phrases of ``k`` words that start at each position, and which exist."""
    n = max(0, len(marks) - k + 1)
    mixed, there = np.zeros(n, dtype=np.uint64), np.ones(n, dtype=bool)
    for j in range(k):
        own = marks[j : j + n]
        mixed = (mixed ^ own) * _MIX
        mixed ^= mixed >> np.uint64(29)
        there &= own != 0
    return (mixed & np.uint64(BITS - 1)).astype(np.int64), there


def _bitmap(frequent: DataFrame, k: int) -> np.ndarray:
    """One bit for every frequent phrase of ``k`` words, made in the tasks; BITS bits in all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = []
            for lang, phrase in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrase")), strict=True):
                words = pa.array(phrase.encode().split(b" "), pa.binary()).dictionary_encode()
                places.append(_phrase_marks(_word_marks(words, lang), k)[0][0])
            yield pa.RecordBatch.from_pydict({"place": pa.array(places, pa.int64())})

    table = (
        frequent.select("lang", "phrase")
        .mapInArrow(run, "place bigint")
        .groupBy(F.floor(F.col("place") / PART).alias("part"))
        .agg(F.bitmap_construct_agg((F.col("place") % PART).cast("bigint")).alias("bits"))
        .toArrow()
    )
    # at most BITS // PART rows
    out = np.zeros((BITS // PART, PART // 8), dtype=np.uint8)
    for part, bits in zip(table.column("part").to_pylist(), table.column("bits").to_pylist(), strict=True):
        out[part] = np.frombuffer(bits, dtype=np.uint8)
    return out.ravel()


def _joined(words: pa.DictionaryArray, at: np.ndarray, k: int) -> pa.Array:
    """The phrases of ``k`` words at the positions ``at``."""
    index = words.indices.to_numpy()
    parts = [words.dictionary.take(pa.array(index[at + j])) for j in range(k)]
    return pc.binary_join_element_wise(*parts, pa.scalar(b" ", pa.binary())) if k > 1 else parts[0]


def _distinct(words: pa.DictionaryArray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """One position of each distinct phrase among those at ``at``, and how many it stands for."""
    index = words.indices.to_numpy().astype(np.int64)
    width = max(1, len(words.dictionary))
    kind = index[at]
    for j in range(1, k):
        kind = np.unique(kind, return_inverse=True)[1] * width + index[at + j]
    _, first, n = np.unique(kind, return_index=True, return_counts=True)
    return at[first], n


def candidates(docs: DataFrame, frequent: DataFrame, part: int, sizes: tuple[int, ...]) -> DataFrame:
    """Phrases of ``sizes`` words whose parts are all in ``frequent``, often enough in all.

    ``frequent`` are the phrases of ``part`` words.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(frequent, part))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for lang, words in _batches(batches):
            place, there = _phrase_marks(_word_marks(words, lang), part)
            there &= (bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            (at,) = np.nonzero(there)
            reach = part
            for k in sizes:
                for reach in range(reach + 1, k + 1):
                    at = at[at + reach - part < len(there)]
                    at = at[there[at + reach - part]]
                if len(at):
                    first, n = _distinct(words, at, k)
                    yield _rows(lang, _joined(words, first, k), n)

    return (
        _texts(docs)
        .mapInArrow(run, "lang string, phrase string, n bigint")
        .groupBy("lang", "phrase")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= FREQUENT)
        .select("lang", "phrase")
    )


def _trie(table: pa.Table) -> tuple[dict[str, dict[bytes, int]], DoubleArray, np.ndarray]:
    """Word codes of each language, the double array, and the accepting place of each row."""
    codes: dict[str, dict[bytes, int]] = {}
    most = 0
    rows = []
    for number, (lang, phrase) in enumerate(
        zip(*(table.column(c).to_pylist() for c in ("lang", "phrase")), strict=True)
    ):
        own = codes.setdefault(lang, {})
        line = []
        for word in phrase.encode().split(b" "):
            if word not in own:
                most += 1
                own[word] = most
            line.append(own[word])
        rows.append((line, number))
    rows.sort()
    start = np.r_[0, np.cumsum([len(line) for line, _ in rows])].astype(np.int64)
    nodes = nodes_of(np.asarray([c for line, _ in rows for c in line], dtype=np.int64), start)
    trie = pack(nodes, most)
    accepts = np.zeros(len(table), dtype=np.int64)
    accepts[[number for _, number in rows]] = trie.place[nodes.last]
    trie.node = np.zeros(0, dtype=np.int64)  # not needed for the walk
    return codes, trie, accepts


def _counted(docs: DataFrame, part: DataFrame) -> DataFrame:
    """``phrase``s of ``part`` with their counts ``n``, by one trie and one pass over ``docs``."""
    table = part.select("lang", "phrase").toArrow()
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_trie(table))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, trie, accepts = shared.value
        total = np.zeros(len(trie.base), dtype=np.int64)
        for lang, words in _batches(batches):
            own = codes.get(lang)
            if not own:
                continue
            of = words.dictionary.to_pylist()
            code = np.fromiter((own.get(w, 0) for w in of), np.int64, len(of))[words.indices.to_numpy()]
            position = np.flatnonzero(code)
            state = np.zeros(len(position), dtype=np.int64)
            for depth in range(LONGEST):
                inside = position + depth < len(code)
                position, state = position[inside], state[inside]
                state = trie.step(state, code[position + depth])
                position, state = position[state >= 0], state[state >= 0]
                total += np.bincount(state, minlength=len(total))
        yield from _blocks({lo // BLOCK: total[accepts[lo : lo + BLOCK]] for lo in range(0, len(accepts), BLOCK)})

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "counts")), strict=True):
                own = np.frombuffer(counts, dtype=np.int64)
                held[block] = held[block] + own if block in held else own
        yield from _blocks(held)

    kind = "block bigint, counts binary"
    parts = _texts(docs).mapInArrow(run, kind).repartition("block").mapInArrow(summed, kind)
    found = np.zeros(len(table), dtype=np.int64)
    for row in parts.toArrow().to_pylist():
        at = row["block"] * BLOCK
        found[at : at + BLOCK] = np.frombuffer(row["counts"], dtype=np.int64)
    return staged(spark.createDataFrame(table.append_column("n", pa.array(found))), "phrase-counts")


def _blocks(counts: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    if counts:
        yield pa.RecordBatch.from_pydict(
            {
                "block": pa.array(list(counts), pa.int64()),
                "counts": pa.array([c.tobytes() for c in counts.values()], pa.binary()),
            }
        )


def phrase_counts(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts of all frequent phrases of 1 to 5 words, and the words ``total`` of every language."""
    ship(docs.sparkSession)
    words = staged(word_counts(docs), "word-counts")
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    single = staged(words.filter(F.col("n") >= FREQUENT).select("lang", "phrase"), "frequent-words")
    pairs = staged(candidates(docs, single, 1, (2,)), "frequent-pairs")
    more = staged(candidates(docs, pairs, 2, tuple(range(3, LONGEST + 1))), "frequent-phrases")
    every = single.union(pairs).union(more)
    passes = max(1, -(-every.count() // TRIE))
    dealt = every.withColumn("_pass", F.pmod(F.xxhash64("lang", "phrase"), F.lit(passes)))
    counts = None
    for number in range(passes):
        part = _counted(docs, dealt.filter(F.col("_pass") == number))
        counts = part if counts is None else counts.union(part)
    return counts, total


def _span(start: int | Column, size: int | Column) -> Column:
    return F.array_join(F.slice("_words", start, size), " ")


def collocations(docs: DataFrame) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of the best phrases."""
    counts, total = phrase_counts(docs)
    whole = counts.filter(F.col("n") >= FREQUENT).withColumn("_words", F.split("phrase", " ")).withColumn("_size", F.size("_words"))
    longer = whole.filter("_size >= 2")
    cut = longer.select(
        "lang",
        "phrase",
        F.col("n").alias("a"),
        F.explode(F.sequence(F.lit(1), F.col("_size") - 1)).alias("_k"),
        "_words",
        "_size",
    ).select(
        "lang", "phrase", "a", "_k",
        _span(1, F.col("_k")).alias("_left"),
        _span(F.col("_k") + 1, F.col("_size") - F.col("_k")).alias("_right"),
    )

    def of(name: str) -> DataFrame:
        return counts.select(
            F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("n").alias(name)
        )

    for side, name in (("_left", "l"), ("_right", "r")):
        cut = cut.join(
            of(name), (F.col("lang") == F.col("_lang")) & (F.col(side) == F.col("_part"))
        ).drop("_lang", "_part", side)
    cut = cut.join(total.select(F.col("lang").alias("_lang"), "total"), F.col("lang") == F.col("_lang"))
    score = F.expr(
        "CAST(1000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) * CAST(total AS DECIMAL(38,0))"
        " DIV (CAST(l AS DECIMAL(38,0)) * CAST(r AS DECIMAL(38,0)))"
    )
    best = (
        cut.select("lang", "phrase", "a", "l", "r", F.col("total").alias("n"), "_k", score.alias("score"))
        .groupBy("lang", "phrase")
        .agg(F.min(F.struct("score", "_k", "a", "l", "r", "n")).alias("_best"))
        .select("lang", "phrase", "_best.*")
    )
    inside = (
        longer.filter("_size >= 3")
        .select(
            F.col("lang").alias("_lang"),
            F.col("n").alias("_n"),
            F.explode(
                F.expr(
                    "flatten(transform(sequence(2, _size - 1), s -> transform(sequence(1, _size - s + 1),"
                    " i -> array_join(slice(_words, i, s), ' '))))"
                )
            ).alias("_part"),
        )
        .groupBy("_lang", "_part")
        .agg(F.max("_n").alias("_most"))
    )
    alone = best.join(
        inside, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_part")), "left"
    ).filter(F.col("_most").isNull() | (F.col("_most") * 100 < F.col("a") * 100))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        alone.withColumn("rank", F.row_number().over(order).cast("bigint"))
        .filter(F.col("rank") <= FIRST)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )
