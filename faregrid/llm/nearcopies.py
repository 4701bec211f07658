"""Near copies of the corpus pipeline: every pair of texts with similarity 0.8 or more.

Similarity is the Jaccard index of the sets of five-word shingles, kept as 64-bit hashes.
Equal sets are one node. Sets whose SimHash fingerprints lie within the distance of the anchors
of ``simhash`` are proposed first, through these anchors. At similarity 0.8 most fingerprints
lie further apart, so a prefix join finds the rest, exactly: with the shingles of every set in one
common order, two sets of similarity s share a shingle among the first
``n - ceil(s * n) + 1`` of each. The order puts shingles with many holders last, as
counted over hash buckets in a quarter of the nodes; how well they are counted changes
the number of proposals, never a result.

Proposals are checked twice. Every shingle flips one bit of a bitmap, so bitmaps differ in
at most as many bits as sets in shingles: pairs beyond what the similarity allows are
dropped without reading a text, those of the second step before they are written at all.
What is left is checked with the whole sets; only their texts are moved, none is staged for
the others.

Only components are asked for. After the pairs of the anchors every holder of a shared shingle is tried against the
smallest holder. Then, ``ROUNDS`` times, every holder is tried against the one of another
component whose bitmap is nearest, which joins most of what is alike. In the end all pairs
of holders that are not yet in one component are tried, so no link between components is
left out. A large group of near copies so gives a few pairs for each shingle of a member.

Defined results: null, empty and blank texts have the empty set and are equal; fewer words
than a shingle count as one shingle; upper and lower case of ASCII letters are alike; an id
that several texts share is a row of each; a group without any id has no ``component_id``;
an empty table gives an empty result; extra columns take no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faregrid.llm.components import components, grown
from faregrid.llm.ship import ship
from faregrid.llm.simhash import _LOWER, _WORD, SEED, links, majority
from faregrid.session import staged

SHINGLE = 5
ABOVE, BELOW = 4, 5  # similarity as a fraction
BUCKETS = 1 << 20
MAP_BITS = 1024
ROUNDS = 1
COUNTED = 4  # one in so many nodes is counted for the order


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text."""
    found = _WORD.findall((text or "").encode().translate(_LOWER))
    if not found:
        return np.zeros(0, dtype=np.uint64)
    if len(found) < SHINGLE:
        grams = [b" ".join(found)]
    else:
        grams = map(b" ".join, zip(*[found[i:] for i in range(SHINGLE)], strict=False))
    hash_of = xxhash.xxh64_intdigest
    return np.unique(np.asarray([hash_of(g, SEED) for g in grams], dtype=np.uint64))


def _node(own: np.ndarray) -> int:
    """Name of a set, as a signed number; 0 for the empty one."""
    name = xxhash.xxh64_intdigest(own.tobytes(), SEED) if len(own) else 0
    return name - (1 << 64) if name >> 63 else name


def _bitmap(own: np.ndarray) -> bytes:
    flips = np.bincount((own >> np.uint64(40)).astype(np.int64) % MAP_BITS, minlength=MAP_BITS)
    return np.packbits(flips & 1).tobytes()


def _fingerprint(own: np.ndarray) -> int:
    """SimHash of a set, as a signed number; 0 for the empty one."""
    fp = majority(own.astype(">u8"))
    return fp - (1 << 64) if fp >> 63 else fp


def _similar(common: int, a: int, b: int) -> bool:
    return common * BELOW >= ABOVE * (a + b - common)


def _marked(docs: DataFrame) -> DataFrame:
    """``doc_id``, the ``node`` of its text, the ``size``, the ``bits`` and ``fp`` of its set."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_hash": batch.column("text_hash"),
                    "node": pa.array([_node(s) for s in sets], pa.int64()),
                    "size": pa.array([len(s) for s in sets], pa.int64()),
                    "bits": pa.array([_bitmap(s) for s in sets], pa.binary()),
                    "fp": pa.array([_fingerprint(s) for s in sets], pa.int64()),
                }
            )

    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(
        run, f"doc_id {id_type}, text_hash bigint, node bigint, size bigint, bits binary, fp bigint"
    )


def _holders(docs: DataFrame) -> np.ndarray:
    """About how many nodes hold a shingle of each bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text"):
                own = shingles(text.as_py())
                node = _node(own)
                if node % COUNTED == 0 and node not in seen:
                    seen.add(node)
                    np.add.at(total, (own % np.uint64(BUCKETS)).astype(np.int64), 1)
        (used,) = np.nonzero(total)
        for start in range(0, len(used), 1 << 16):
            part = used[start : start + (1 << 16)]
            yield pa.RecordBatch.from_pydict(
                {"bucket": pa.array(part.astype(np.int32)), "n": pa.array(total[part])}
            )

    table = (
        docs.select("text")
        .mapInArrow(run, "bucket int, n bigint")
        .groupBy("bucket")
        .agg(F.least(F.sum("n"), F.lit(2**31 - 1)).cast("int").alias("n"))
        .toArrow()
    )
    counts = np.zeros(BUCKETS, dtype=np.int32)  # 32 bits halve what the driver holds
    counts[table.column("bucket").to_numpy()] = table.column("n").to_numpy()
    return counts


def _prefixes(docs: DataFrame) -> DataFrame:
    """``token``, ``node``, ``size`` and place ``at`` of the first shingles of every set."""
    shared_counts = docs.sparkSession.sparkContext.broadcast(_holders(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared_counts.value
        seen: set[int] = set()
        for batch in batches:
            tokens, nodes, sizes = [], [], []
            for text in batch.column("text"):
                own = shingles(text.as_py())
                node = _node(own)
                if node in seen or not len(own):
                    continue
                seen.add(node)
                order = np.lexsort((own, counts[(own % np.uint64(BUCKETS)).astype(np.int64)]))
                least = -(-ABOVE * len(own) // BELOW)
                tokens.append(own[order[: len(own) - least + 1]])
                nodes.append(node)
                sizes.append(len(own))
            if not tokens:
                continue
            n = [len(t) for t in tokens]
            yield pa.RecordBatch.from_pydict(
                {
                    "token": pa.array(np.concatenate(tokens).view(np.int64)),
                    "node": pa.array(np.repeat(np.asarray(nodes, dtype=np.int64), n)),
                    "size": pa.array(np.repeat(np.asarray(sizes, dtype=np.int64), n)),
                    "at": pa.array(np.concatenate([np.arange(k) for k in n])),
                }
            )

    return docs.select("text").mapInArrow(run, "token bigint, node bigint, size bigint, at bigint")


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]):
    """Whole groups of equal first column, from batches sorted by it."""
    held: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in names))
        if held[-1][0][-1] == held[0][0][0]:
            continue
        whole = [np.concatenate(x) for x in zip(*held, strict=True)]
        cut = int(np.searchsorted(whole[0], whole[0][-1]))
        yield [x[:cut] for x in whole]
        held = [tuple(x[cut:] for x in whole)]
    if held:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _shared(prefixes: DataFrame) -> DataFrame:
    """The rows of ``prefixes`` whose shingle has more than one node, each once."""
    names = ("token", "node", "size", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, node, size, at in _groups(batches, names):
            new = np.r_[True, (token[1:] != token[:-1]) | (node[1:] != node[:-1])]
            cols = [x[new] for x in (token, node, size, at)]
            same = cols[0][1:] == cols[0][:-1]
            more = np.r_[False, same] | np.r_[same, False]
            if more.any():
                yield pa.RecordBatch.from_pydict(
                    {c: pa.array(x[more]) for c, x in zip(names, cols, strict=True)}
                )

    by_token = prefixes.repartition("token").sortWithinPartitions("token", "node")
    return by_token.mapInArrow(run, "token bigint, node bigint, size bigint, at bigint")


def _maps(bits: Iterable[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bits), dtype=np.uint64).reshape(-1, MAP_BITS // 64)


def _near(apart: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Whether sets with bitmaps ``apart`` by so many bits can be similar, given both sizes."""
    return apart * (ABOVE + BELOW) <= both * (BELOW - ABOVE)


def _across(held: DataFrame, nearest: bool = False) -> DataFrame:
    """Pairs ``a`` < ``b`` that share a shingle, stand in different components ``root`` and whose
    bitmaps ``bits`` are near enough; ``nearest``: of each holder of a shingle only the nearest."""
    names = ("token", "node", "size", "at", "root", "bits")

    def pairs_of(node, size, at, root, bits) -> Iterator[pa.RecordBatch]:
        kinds, kind = np.unique(root, return_inverse=True)
        if len(kinds) < 2:
            return
        most = np.bincount(kind).argmax()  # its members are only met by others
        bits = _maps(bits)
        for i in np.flatnonzero(kind != most):
            other = kind != kind[i]
            if not nearest:
                other &= (kind == most) | (np.arange(len(kind)) > i)
            # what may still follow the shingle in both sets bounds what they share
            common = np.minimum(size - at, size[i] - at[i]) + np.minimum(at, at[i])
            other &= common * (ABOVE + BELOW) >= ABOVE * (size + size[i])
            (place,) = np.nonzero(other)
            apart = np.bitwise_count(bits[place] ^ bits[i]).sum(axis=1, dtype=np.int64)
            near = _near(apart, size[place] + size[i])
            place, apart = place[near], apart[near]
            found = node[place[[apart.argmin()]] if nearest and len(place) else place]
            if len(found):
                yield pa.RecordBatch.from_pydict(
                    {
                        "a": pa.array(np.minimum(found, node[i])),
                        "b": pa.array(np.maximum(found, node[i])),
                    }
                )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, *rest in _groups(batches, names):
            edge = np.flatnonzero(np.r_[True, token[1:] != token[:-1], True])
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                yield from pairs_of(*[x[lo:hi] for x in rest])

    by_token = held.select(*names).repartition("token").sortWithinPartitions("token")
    return by_token.mapInArrow(run, "a bigint, b bigint").distinct()


def _checked(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, bitmaps: bool) -> DataFrame:
    """The ``pairs`` whose sets are similar; ``bitmaps``: those with bitmaps too far apart go first."""

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                name = xxhash.xxh128_digest(text or "")
                if name not in seen:
                    seen.add(name)
                    rows.append((_node(shingles(text)), text))
            if rows:
                node, text = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node, pa.int64()), pa.array(text, pa.string())], ["node", "text"]
                )

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (_maps(batch.column(c).to_pylist()) for c in ("bits_a", "bits_b"))
            apart = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
            both = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(_near(apart, both)))

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[int, np.ndarray] = {}
        for batch in batches:
            keep = []
            for a, x, y in zip(
                batch.column("a").to_pylist(), batch.column("text_a"), batch.column("text_b"), strict=True
            ):
                if a not in last:
                    last = {a: shingles(x.as_py())}
                right = shingles(y.as_py())
                common = len(np.intersect1d(last[a], right, assume_unique=True))
                keep.append(_similar(common, len(last[a]), len(right)))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def own(side: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(side if c == "node" else f"{c}_{side}") for c in df.columns])

    if bitmaps:
        sketch = nodes.select("node", "size", "bits")
        met = pairs.join(own("a", sketch), "a").join(own("b", sketch), "b")
        pairs = met.mapInArrow(possible, "a bigint, b bigint")
    close = staged(pairs, "close-pairs")
    needed = close.select(F.col("a").alias("_n")).union(close.select("b")).distinct()
    # one document of each node gives its text
    source = nodes.join(needed, F.col("node") == F.col("_n"), "left_semi").select(
        F.col("first_text").alias("_first")
    )
    texts = staged(
        docs.select("text", F.xxhash64("text").alias("_hash"))
        .join(source, F.col("_hash") == F.col("_first"), "left_semi")
        .select("text")
        .mapInArrow(named, "node bigint, text string")
        .dropDuplicates(["node"]),
        "paired-texts",
    )
    whole = close.join(own("a", texts), "a").join(own("b", texts), "b")
    columns = whole.select("a", "b", "text_a", "text_b")
    return staged(columns.mapInArrow(similar, "a bigint, b bigint"), "similar-pairs")


def _anchored(nodes: DataFrame) -> DataFrame:
    """Pairs ``a`` < ``b`` that span all sets whose fingerprints meet at an anchor, or are equal."""
    held = nodes.filter("size > 0")
    first = staged(held.groupBy("fp").agg(F.min("node").alias("node")), "fingerprint-sets")
    equal = held.join(first.withColumnRenamed("node", "_first"), "fp").filter("node <> _first")
    met = links(first).union(equal.select("node", "_first"))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _mixed(shared: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Holders of the shingles that stand in more than one component, with ``root`` and ``bits``."""
    found = found.select(F.col("node").alias("_node"), "component")
    rooted = staged(
        shared.join(found, F.col("node") == F.col("_node"), "left").select(
            *shared.columns, F.coalesce("component", "node").alias("root")
        ),
        "rooted-shingles",
    )
    mixed = (
        rooted.groupBy("token")
        .agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
        .filter("_low < _high")
        .select("token")
    )
    sketch = nodes.select(F.col("node").alias("_node"), "bits")
    return rooted.join(mixed, "token", "left_semi").join(sketch, F.col("node") == F.col("_node"))


def near_copies(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``component_id``, the smallest ``doc_id`` of its group, of every document.

    ``text_hash`` tells apart rows that share an id; ``first_hash`` is that of the row which
    stands for the group. Both are null where a group has no id at all.
    """
    ship(docs.sparkSession)
    marked = staged(_marked(docs), "shingled")
    id_and_text = F.struct(F.col("doc_id").cast("bigint").alias("doc_id"), "text_hash")
    nodes = staged(
        marked.groupBy("node").agg(
            F.min(F.when(F.col("doc_id").isNotNull(), id_and_text)).alias("first"),
            F.min("text_hash").alias("first_text"),
            F.first("size").alias("size"),
            F.first("bits").alias("bits"),
            F.first("fp").alias("fp"),
        ),
        "shingle-sets",
    )
    tried = staged(_anchored(nodes), "anchor-pairs")
    linked = _checked(tried, nodes, docs, bitmaps=True)
    shared = staged(_shared(_prefixes(docs)), "shared-shingles")
    first = shared.groupBy("token").agg(F.min(F.struct("size", "node")).alias("_least"))
    star = (
        shared.join(first, "token")
        .filter(F.col("node") != F.col("_least.node"))
        .filter(F.col("_least.size") * BELOW >= F.col("size") * ABOVE)
        .select(
            F.least("node", "_least.node").alias("a"), F.greatest("node", "_least.node").alias("b")
        )
        .distinct()
    )
    met = staged(star.join(tried, ["a", "b"], "left_anti"), "star-pairs")
    linked = linked.union(_checked(met, nodes, docs, bitmaps=True))
    found = staged(components(linked), "components")
    tried = tried.union(met)
    for _ in range(ROUNDS):
        held = _mixed(shared, nodes, found)
        met = staged(_across(held, nearest=True).join(tried, ["a", "b"], "left_anti"), "nearest-pairs")
        found = grown(found, _checked(met, nodes, docs, bitmaps=False))
        tried = tried.union(met)
    rest = _across(_mixed(shared, nodes, found)).join(tried, ["a", "b"], "left_anti")
    found = grown(found, _checked(rest, nodes, docs, bitmaps=False))
    found = found.select(F.col("node").alias("_node"), "component")
    member = nodes.join(found, F.col("node") == F.col("_node"), "left").select(
        "node", "first", F.coalesce("component", "node").alias("root")
    )
    least = member.groupBy("root").agg(F.min("first").alias("_group"))
    label = staged(member.join(least, "root").select("node", "_group"), "copy-labels")
    return marked.join(label, "node").select(
        "doc_id",
        F.col("_group.doc_id").cast(docs.schema["doc_id"].dataType).alias("component_id"),
        "text_hash",
        F.col("_group.text_hash").alias("first_hash"),
    )
