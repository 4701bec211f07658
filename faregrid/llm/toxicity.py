"""Toxicity by weak supervision: many small voters, a generative model of them, a linear classifier.

Fit, on at most ``SAMPLE`` labelled rows of each label (by smallest hash of the id):

1. Terms, which are words and word beginnings, are counted per label; those that tell the
   labels apart (likelihood ratio of at least ``TELLS``) make up the lexicons, dealt over
   several voters. Patterns and a short fixed list vote as well. A voter says toxic,
   clean or nothing.
2. The label model knows votes only. Expectation maximisation estimates the share of
   toxic rows and what every voter says on either kind. Voters whose votes still go together
   within a kind are put into one factor with a joint table, so that what they have in common
   counts once; then the model is estimated anew.
3. A logistic regression over hashed terms learns the posterior labels of the model, which
   carry over to texts that no voter speaks on. Its constant is moved from the share of
   toxic rows of the sample to that of all labelled rows given.

Scoring is one pass without a shuffle; whole texts are read, and the weights are a table
of ``BUCKETS`` numbers whatever the input.

Defined results: null and empty texts have no term and get the score of the constant; a row
labelled twice is toxic if any label says so; labels other than 0 and 1 are ignored; without
labels of both kinds every score is 0; rows with a null id take no part in the fit. Extra
columns are dropped.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faregrid.llm.ship import ship
from faregrid.session import staged

SAMPLE = 4000
TELLS = 20.0
KEEPS = 15.0
LEXICON = 480
GROUPS = 8
LEAST_DOCS = 3
BUCKETS = 1 << 20
BEGINNINGS = (4, 5, 6)
ROUNDS = 60
TOGETHER = 0.25  # correlation within a kind from which two voters are one factor
MOST_IN_FACTOR = 3

ABSTAIN, CLEAN, TOXIC = 0, 1, 2

# fixed values: common insults, lower case
INSULTS = frozenset(
    """
    arsehole asshole bastard bitch clown cretin disgusting dumb fool idiot imbecile jerk
    loser moron pathetic scum scumbag stupid trash worthless
    abschaum arschloch blödmann depp dummkopf idioten mistkerl trottel versager
    abruti connard crétin débile imbécile ordure salaud
    basura cabrón estúpido gilipollas idiota imbécil inútil pendejo
    """.split()
)

_WORD = re.compile(r"[^\W\d_]+")
_PATTERNS = (
    ("exclaims", re.compile(r"!{2,}|\?!|!\?")),
    ("shouts", re.compile(r"\b[^\W\d_a-zß-ÿ]{4,}\b(?:[^\w\n]+\b[^\W\d_a-zß-ÿ]{4,}\b){2}")),
    ("masks", re.compile(r"\b[^\W\d_]\*{2,}[^\W\d_]?")),
    ("stretches", re.compile(r"([^\W\d_])\1{3,}")),
    ("addresses", re.compile(r"\b(?:you|you're|du bist|tu es|eres)\s+(?:are\s+)?(?:an?|ein|un)\b", re.I)),
)


def terms(text: str | None) -> set[str]:
    """Words of three letters or more, and beginnings, marked by a star."""
    words = {w for w in _WORD.findall((text or "").lower()) if len(w) > 2}
    return words | {w[:n] + "*" for n in BEGINNINGS for w in words if len(w) > n}


def _places(found: set[str]) -> np.ndarray:
    crc = zlib.crc32
    places = np.fromiter((crc(t.encode()) for t in found), np.int64, len(found))
    return np.unique(places & (BUCKETS - 1))


def _kind(text: str | None) -> int:
    """Smallest hash of five words in a row: mostly equal for near copies, else different."""
    words = (text or "").split()
    rows = zip(*[words[i:] for i in range(5)], strict=False) if len(words) > 5 else [words]
    return min(xxhash.xxh64_intdigest(" ".join(row)) for row in rows) >> 1


def sample_of(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text`` and ``toxic`` of at most ``SAMPLE`` rows of each label, near copies once.

    Copies of one toxic text would make its plain words look toxic.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = pa.array([_kind(t.as_py()) for t in batch.column("text")], pa.int64())
            yield batch.select(["text", "toxic"]).append_column("kind", kinds)

    known = (
        labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    order = Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id")
    drawn = known.withColumn("_row", F.row_number().over(order)).filter(F.col("_row") <= SAMPLE)
    drawn = staged(drawn.select(F.col("doc_id").alias("_drawn"), "toxic"), "drawn-labels")
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    met = (
        own.join(drawn, F.col("doc_id") == F.col("_drawn"))
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("toxic").alias("toxic"))
    )
    one = (
        met.mapInArrow(run, "text string, toxic int, kind bigint")
        .groupBy("kind")
        .agg(F.max(F.struct("toxic", "text")).alias("row"))
    )
    return staged(one.select("row.text", "row.toxic"), "labelled-texts")


def lexicons(sample: DataFrame) -> tuple[list[str], list[str]]:
    """Terms of toxic and of clean rows that tell the two apart, the best first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column("text"), batch.column("toxic").to_pylist(), strict=True):
                for term in terms(text.as_py()):
                    held.setdefault(term, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_pydict(
                {
                    "term": pa.array(list(held), pa.string()),
                    "n0": pa.array([n[0] for n in held.values()], pa.int64()),
                    "n1": pa.array([n[1] for n in held.values()], pa.int64()),
                }
            )

    rows = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    all0, all1 = float(rows.get(0, 0)), float(rows.get(1, 0))
    share = all1 / (all0 + all1)
    n0, n1 = F.col("n0"), F.col("n1")

    def part(seen: Column, expected: float) -> Column:
        return F.when(seen > 0, 2 * seen * F.log(seen / ((n0 + n1) * expected))).otherwise(0.0)

    counted = (
        sample.select("text", "toxic")
        .mapInArrow(run, "term string, n0 bigint, n1 bigint")
        .groupBy("term")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .filter(n0 + n1 >= LEAST_DOCS)
        .withColumn("ratio", part(n0, 1 - share) + part(n1, share))
        .filter(F.col("ratio") >= TELLS)
    )
    counted = staged(counted, "telling-terms")

    def best(of: Column, most: int) -> list[str]:
        top = counted.filter(of).orderBy(F.desc("ratio"), "term").limit(most)
        return [r["term"] for r in top.select("term").collect()]

    mostly = (n1 + 0.5) / (all1 + 1) >= 8 * (n0 + 0.5) / (all0 + 1)
    clean = (n0 + 0.5) / (all0 + 1) >= 3 * (n1 + 0.5) / (all1 + 1)
    return best(mostly, LEXICON), best(clean, LEXICON // 4)


@dataclass
class Voters:
    names: list[str]
    toxic: list[frozenset[str]]
    clean: frozenset[str]

    def votes(self, text: str | None, found: set[str]) -> list[int]:
        hits = [bool(found & lexicon) for lexicon in self.toxic]
        out = [TOXIC if hit else ABSTAIN for hit in hits]
        out += [TOXIC if pattern.search(text or "") else ABSTAIN for _, pattern in _PATTERNS]
        some = any(hits)
        out.append(CLEAN if found and not some else ABSTAIN)
        out.append(CLEAN if len(found & self.clean) > 1 and not some else ABSTAIN)
        return out


def voters_of(toxic: list[str], clean: list[str]) -> Voters:
    """Words and beginnings each dealt over ``GROUPS`` lexicons in turn, best first."""
    words = [t for t in toxic if not t.endswith("*")]
    starts = [t for t in toxic if t.endswith("*")]
    groups = [("insults", INSULTS)]
    for kind, of in (("words", words), ("beginnings", starts)):
        groups += [(f"{kind}-{g}", frozenset(of[g::GROUPS])) for g in range(GROUPS)]
    names = [n for n, _ in groups] + [n for n, _ in _PATTERNS] + ["no hit", "plain terms"]
    return Voters(names, [g for _, g in groups], frozenset(clean))


@dataclass
class LabelModel:
    share: float
    factors: list[tuple[int, ...]]  # voters of each factor
    tables: list[np.ndarray]  # per factor: chance of every joint vote, given clean and toxic
    accuracy: np.ndarray  # of each voter's votes, where it has any
    correlation: np.ndarray  # between voters, within a kind

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = np.full(len(votes), np.log(self.share / (1 - self.share)))
        for factor, table in zip(self.factors, self.tables, strict=True):
            log = np.log(table[:, _joint(votes, factor)])
            odds += log[1] - log[0]
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def _joint(votes: np.ndarray, factor: tuple[int, ...]) -> np.ndarray:
    code = np.zeros(len(votes), dtype=np.int64)
    for voter in factor:
        code = code * 3 + votes[:, voter]
    return code


def _estimated(votes: np.ndarray, factors: list[tuple[int, ...]], p: np.ndarray):
    codes = [_joint(votes, f) for f in factors]
    for _ in range(ROUNDS):
        share = float(np.clip(p.mean(), 1e-3, 1 - 1e-3))
        tables, odds = [], np.full(len(votes), np.log(share / (1 - share)))
        for factor, code in zip(factors, codes, strict=True):
            width = 3 ** len(factor)
            counts = np.stack([np.bincount(code, w, width) for w in (1 - p, p)]) + 0.1
            table = counts / counts.sum(axis=1, keepdims=True)
            tables.append(table)
            log = np.log(table[:, code])
            odds += log[1] - log[0]
        new = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        done = np.abs(new - p).max() < 1e-6
        p = new
        if done:
            break
    return share, tables, p


def _balance(votes: np.ndarray, factors: list[tuple[int, ...]]) -> np.ndarray:
    sign = (votes == TOXIC).astype(float) - (votes == CLEAN)
    total = sum(sign[:, factor].mean(axis=1) for factor in factors)
    return np.where(total > 0, 0.9, 0.1)


def _within(votes: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Correlation of the voters' signs within a kind, the larger of the two kinds."""
    sign = (votes == TOXIC).astype(float) - (votes == CLEAN)
    out = np.zeros((votes.shape[1],) * 2)
    for w in (p, 1 - p):
        if w.sum() < 20:
            continue
        mean = w @ sign / w.sum()
        off = (sign - mean) * np.sqrt(w)[:, None]
        cov = off.T @ off / w.sum()
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        cor = cov / np.outer(sd, sd)
        cor[(sd < 1e-3)[:, None] | (sd < 1e-3)[None, :]] = 0
        out = np.where(np.abs(cor) > np.abs(out), cor, out)
    np.fill_diagonal(out, 0)
    return out


def label_model(votes: np.ndarray) -> LabelModel:
    """What every voter says on clean and toxic rows, from the votes alone.

    Each estimate starts from the balance of the votes of each row, a factor counting once:
    voters that copy each other would else be taken for what is to be found.
    """
    n = votes.shape[1]
    single = [(v,) for v in range(n)]
    _, _, p = _estimated(votes, single, _balance(votes, single))
    correlation = _within(votes, p)
    member = list(range(n))
    for i, j in zip(*np.unravel_index(np.argsort(-np.abs(correlation), axis=None), (n, n)), strict=True):
        if abs(correlation[i, j]) < TOGETHER:
            break
        a, b = member[i], member[j]
        if a != b and member.count(a) + member.count(b) <= MOST_IN_FACTOR:
            member = [a if m == b else m for m in member]
    factors = [tuple(v for v in range(n) if member[v] == m) for m in sorted(set(member))]
    share, tables, p = _estimated(votes, factors, _balance(votes, factors))
    right = np.where(votes == TOXIC, p[:, None], 1 - p[:, None]) * (votes != ABSTAIN)
    accuracy = right.sum(axis=0) / np.maximum((votes != ABSTAIN).sum(axis=0), 1)
    return LabelModel(share, factors, tables, accuracy, correlation)


def _ratio(mass: np.ndarray, seen: np.ndarray, share: float) -> np.ndarray:
    """Likelihood ratio of the toxic ``mass`` among the rows ``seen`` against ``share``."""
    part = np.zeros(len(seen))
    for own, expected in ((mass, share * seen), (seen - mass, (1 - share) * seen)):
        some = own > 1e-9
        part[some] += 2 * own[some] * np.log(own[some] / expected[some])
    return part


def _linear(rows: list[np.ndarray], p: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and constant of a logistic regression on soft labels, by steps per coordinate.

    Only terms that tell the posterior labels apart have a weight: a text of twenty thousand
    words would else drown in the noise of the others.
    """
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    seen = np.bincount(flat, minlength=BUCKETS)
    mass = np.bincount(flat, np.repeat(p, [len(r) for r in rows]), BUCKETS)
    used = np.flatnonzero((seen >= LEAST_DOCS) & (_ratio(mass, seen, p.mean()) >= KEEPS))
    column = np.full(BUCKETS, -1, dtype=np.int64)
    column[used] = np.arange(len(used))
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    at = column[flat]
    row, at = row[at >= 0], at[at >= 0]
    w, b, n = np.zeros(len(used)), 0.0, len(rows)
    sum_w, sum_b = np.full(len(used), 1e-8), 1e-8
    for _ in range(200):
        z = np.bincount(row, w[at], n) + b
        off = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - p
        g = np.bincount(at, off[row], len(used)) / n + 1e-4 * w
        sum_w += g * g
        sum_b += off.mean() ** 2
        w -= 0.5 * g / np.sqrt(sum_w)
        b -= 0.5 * off.mean() / np.sqrt(sum_b)
    out = np.zeros(BUCKETS, dtype=np.float32)
    out[used] = w
    return out, b


@dataclass
class Model:
    weights: np.ndarray
    constant: float
    voters: Voters | None = None
    labels: LabelModel | None = None


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The classifier from ``docs`` and their ``labels`` (``doc_id``, ``toxic``)."""
    ship(docs.sparkSession)
    sample = sample_of(docs, labels)
    rows = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if len(rows) < 2:
        return Model(np.zeros(BUCKETS, dtype=np.float32), -np.inf)
    voters = voters_of(*lexicons(sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            votes, places = [], []
            for text in batch.column("text").to_pylist():
                found = terms(text)
                votes.append(voters.votes(text, found))
                places.append(_places(found).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_pydict(
                {"votes": pa.array([bytes(v) for v in votes], pa.binary()), "places": pa.array(places, pa.binary())}
            )

    table = sample.select("text").mapInArrow(run, "votes binary, places binary").toArrow()
    cells = sorted(zip(*(table.column(c).to_pylist() for c in ("votes", "places")), strict=True))
    votes = np.asarray([list(v) for v, _ in cells], dtype=np.int64)
    model = label_model(votes)
    weights, constant = _linear([np.frombuffer(x, np.int32).astype(np.int64) for _, x in cells], model.posterior(votes))
    every = {r["toxic"]: r["count"] for r in labels.filter("toxic IN (0, 1)").groupBy("toxic").count().collect()}
    constant += np.log(every[1] / every[0]) - np.log(rows[1] / rows[0])
    return Model(weights, float(constant), voters, model)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((model.weights, model.constant))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, constant = shared.value
        for batch in batches:
            z = np.fromiter(
                (weights[_places(terms(t.as_py()))].sum(dtype=np.float64) for t in batch.column("text")),
                np.float64,
                batch.num_rows,
            )
            score = 1 / (1 + np.exp(-np.clip(z + constant, -500, 500)))
            score[np.isneginf(z + constant)] = 0.0
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "score": pa.array(score),
                    "predicted": pa.array((score >= 0.5).astype(np.int32)),
                }
            )

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        run, f"doc_id {id_type}, score double, predicted int"
    )
