"""Rule-based quality filter: one projection of length, symbol, stop-word and line ratios.

A table of thresholds is compiled into column expressions; there is no shuffle, no
join and no user function, and every ratio is taken over the whole text.

Defined results: a null or empty text has no words and fails the base rule; repeated
rows each get the same verdict; an empty table gives an empty result; further columns
of the input, whatever their names, do not take part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faregrid.llm.words import computed_once, put_back, set_aside, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Frequent function words of the four languages of the corpus.
STOP_WORDS = (
    "the and of to in that is was for on with this are not be by it from or an at as "
    "de la le les et des est que pour un une dans qui du au en pas sur par avec "
    "der die und das den von zu mit im für ist nicht auf ein eine dem sich des "
    "el los las por con para una del se lo como más su al"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= measure <= high`` must hold; a bound of None is open."""

    name: str
    measure: str
    low: float | None = None
    high: float | None = None


# measure: an SQL expression over the counts of ``measured``
RULES = (
    Rule("mean_word_chars", "word_chars / n_words", 2.0, 14.0),
    Rule("symbols_per_word", "n_symbols / n_words", None, 0.25),
    Rule("shouts_per_word", "n_shouts / n_words", None, 0.25),
    Rule("letter_words", "n_letter_words / n_words", 0.7, None),
    Rule("stop_words", "n_stop_words / n_words", 0.02, None),
    Rule("dup_lines", "n_dup_lines / n_lines", None, 0.5),
    Rule("repeat_words", "n_repeat_words / n_words", None, 0.4),
)


def _characters(text: Column, some: str) -> Column:
    rest = F.regexp_replace(text, f"[{some}]+", "")
    return (F.length(text) - F.length(rest)).cast("bigint")


_WINDOW = "concat_ws(' ', get(_words, {i}), get(_words, {i} + 1), get(_words, {i} + 2))"


def _repeated(windows: str) -> str:
    """SQL: sorted places of the windows that equal another, from structs ``s``, ``p``."""
    return f"""transform(array(sort_array({windows})), w -> sort_array(transform(
        filter(w, (x, i) -> x.s <=> get(w, i - 1).s or x.s <=> get(w, i + 1).s),
        x -> x.p)))[0]"""


def measured(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns of ``docs`` and the counts the rules are made of.

    ``n_repeat_words`` counts the words that stand in a three-word window found twice
    or more: the windows are sorted with their places, equal neighbours give the
    places, and gaps between the sorted places give the words covered. Windows are
    sorted by a hash, and by themselves in a text where two windows share one. All of it
    stays inside the row, so a long or repetitive text costs n log n.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    base = computed_once(
        docs,
        *keep,
        _words=words(F.col("text")),
        _lines=lines,
        n_symbols=_characters(text, SYMBOLS),
        n_shouts=_characters(text, "!"),
    )
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    counted = computed_once(
        base,
        *keep,
        "_words",
        "n_symbols",
        "n_shouts",
        word_chars=F.length(F.array_join("_words", "")).cast("bigint"),
        n_words=F.size("_words").cast("bigint"),
        n_lines=F.size("_lines").cast("bigint"),
        n_dup_lines=(F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        n_letter_words=F.expr(r"size(filter(_words, w -> w rlike '\\p{L}'))").cast("bigint"),
        n_stop_words=F.expr(
            f"size(filter(_words, w -> trim(trailing '.,!?;:' from lower(w)) in ({stop})))"
        ).cast("bigint"),
        _hashes=F.expr(
            "if(size(_words) < 3, array(), transform(sequence(0, size(_words) - 3),"
            " i -> xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2))))"
        ),
    )
    by_hash = _repeated("transform(_hashes, (h, i) -> named_struct('s', h, 'p', i))")
    by_text = _repeated(
        f"transform(_hashes, (h, i) -> named_struct('s', {_WINDOW.format(i='i')}, 'p', i))"
    )
    rest = [c for c in counted.columns if c not in ("_words", "_hashes")]
    some = computed_once(
        counted,
        *rest,
        "_words",
        "_hashes",
        _places=F.expr(f"if(size(array_distinct(_hashes)) = size(_hashes), array(), {by_hash})"),
    )
    # as many different windows as hashes among the places, or else two share a hash
    true = f"""size(array_distinct(transform(_places, p -> {_WINDOW.format(i="p")})))
        = size(array_distinct(transform(_places, p -> get(_hashes, p))))"""
    placed = computed_once(
        some, *rest, _places=F.expr(f"if(size(_places) = 0 or {true}, _places, {by_text})")
    )
    covered = F.expr(
        "aggregate(transform(_places, (p, i) ->"
        " if(i = 0, 3, least(3, p - get(_places, i - 1)))), 0, (a, x) -> a + x)"
    )
    return placed.withColumn("n_repeat_words", covered.cast("bigint")).drop("_places")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _passes(rule: Rule) -> Column:
    # the base rule has already asked for words, so the divisors are not zero
    value = F.expr(rule.measure.replace(" / ", " / nullif(") + ", 0)")
    bounds = [value >= rule.low] if rule.low is not None else []
    bounds += [value <= rule.high] if rule.high is not None else []
    out = bounds[0] if len(bounds) == 1 else bounds[0] & bounds[1]
    return F.coalesce(out, F.lit(False))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where the base rule and every threshold hold."""
    out = ~base_failed()
    for rule in rules:
        out = out & _passes(rule)
    return out


def failed_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """Names of the thresholds that do not hold, in table order."""
    names = F.array(*[F.when(~_passes(r), F.lit(r.name)) for r in rules])
    return F.array_compact(names)


def quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: the counts, ``base_failed``, ``kept`` and ``failed_rules``."""
    return measured(docs, "doc_id").select(
        "*",
        base_failed().alias("base_failed"),
        verdict(rules).alias("kept"),
        failed_rules(rules).alias("failed_rules"),
    )


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with exactly their columns."""
    whole, names = set_aside(docs, "text")
    return put_back(measured(whole, *names.values()).filter(verdict(rules)), names)
