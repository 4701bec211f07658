r"""Personal data by candidates and boosted trees, as column expressions only.

Spans of the base kinds (e-mail, IPv4, card, phone) come from fixed patterns and always
stay. They are blanked out, and high-recall generators propose further spans in what
is left: numbers in other groupings, two cards in one run, addresses written out. A
span gets features of its format (digits, Luhn sum, groups, signs) and of its context
(neighbouring characters, hints in front); boosted trees, one ensemble per kind, turn
them into a margin, and a threshold per kind, calibrated on held-out examples, selects.
Of selected spans that overlap, the one that begins first, then the longest, stays.

The trees are fitted on examples that Spark makes from row numbers: formats filled with
hashed digits, true ones and look-alikes (order numbers, dates, versions, ids). They are
compiled into one SQL expression; the main path is a projection without a shuffle.

Patterns with an open start are written so that they fail at once inside a run of their
characters, which keeps long runs linear; a match can also begin where the last ended.

Defined results: a null or empty text has no spans; positions count code points, the end
is exclusive; repeated rows repeat their result; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faregrid.llm import boosting
from faregrid.llm.words import computed_once, put_back, set_aside

KINDS = ("email", "ip", "card", "phone")

_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

_DIGITS = "translate({s}, ' ().-+', '')"
# value of each digit of a card, doubled at every second place from the right
_LUHN = (
    "aggregate(sequence(1, length({d})), 0, (a, i) -> a + if((length({d}) - i) % 2 = 0,"
    " int(substr({d}, i, 1)), int(substr('0246813579', int(substr({d}, i, 1)) + 1, 1)))) % 10 = 0"
)


def _luhn(digits: str) -> str:
    return _LUHN.replace("{d}", digits)


CHECKS = {
    "email": "true",
    "ip": "forall(split(x, '[.]'), p -> length(trim(leading '0' from p)) < 4"
    " and int(concat('0', right(p, 3))) <= 255)",
    "card": f"length({_DIGITS.format(s='x')}) between 12 and 19"
    f" and {_luhn(_DIGITS.format(s='x'))}",
    "phone": f"length({_DIGITS.format(s='x')}) between 9 and 15",
}

# kind and pattern of the spans proposed beside the base ones
GENERATORS = (
    ("email", r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++ ?(?:@|(?i:\[at\]|\(at\)|at )) ?"
              r"[\p{L}\p{N}-]++(?: ?(?:\.|(?i:\[dot\]|\(dot\)|dot )) ?[\p{L}\p{N}-]++)++"),
    ("ip", r"(?<![0-9.])[0-9]{1,3}(?: ?(?:\.|\[\.\]|\(\.\)) ?[0-9]{1,3}){3}(?![0-9])"),
    ("ip", r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::{1,2}[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Fa-f:])"),
    ("card", r"(?<![0-9])[0-9]{13,19}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[\x20./-]{1,2}[0-9]{4}){3}(?![0-9])"),
    ("card", r"(?<![0-9])[0-9]{4}[\x20./-][0-9]{6}[\x20./-][0-9]{5}(?![0-9])"),
    ("phone", r"(?<![0-9.])\(?[0-9]{3}\)?[\x20./-]{0,2}[0-9]{3}[\x20./-][0-9]{4}(?![0-9])"),
    ("phone", r"(?<![0-9.])00[1-9][0-9]{0,2}(?:[\x20./()-]{1,2}[0-9]{2,5}){2,5}(?![0-9])"),
    ("phone", r"(?<![0-9.])0[1-9][0-9]{0,4}(?:[\x20./()-]{1,2}[0-9]{2,8}){1,5}(?![0-9])"),
)

# what a text must hold for a pattern to match, as its pattern implies; no match is lost
BASE_NEEDS = {"email": "contains({t}, '@')", "ip": "_digit", "card": "_digit", "phone": "_digit"}
NEEDS = {
    "email": r"_rest rlike r'(?i)@|at[ \])]'",
    "ip": "_digit or contains(_rest, ':')",
    "card": "_digit",
    "phone": "_digit",
}

HINTS = {
    "email": r"(?i)(?:mail|contact|kontakt|correo|courriel|write|reach)\\W{0,12}(?:\\w+\\W+){0,2}$",
    "ip": r"(?i)(?:\\bip\\b|host|server|client|addr\\w*|from|ping)\\W{0,12}(?:\\w+\\W+){0,2}$",
    "card": r"(?i)(?:card|visa|master\\w*|amex|kredit\\w*|carte|tarjeta|pay\\w*|cc)"
    r"\\W{0,12}(?:\\w+\\W+){0,2}$",
    "phone": r"(?i)(?:tel\\w*|phone|call|mobil\\w*|cell|fax|ruf\\w*|whatsapp)"
    r"\\W{0,12}(?:\\w+\\W+){0,2}$",
}
AGAINST = (
    r"(?i)(?:order|invoice|isbn|ref\\w*|version|\\bv|serial|item|part|ticket|build|page|id|no|nr)"
    r"\\W{0,6}(?:\\w+\\W+){0,1}$"
)
CONTEXT = 32
PIECE = 4096
FEATURES = (
    "digits", "letters", "chars", "groups", "longest_group", "luhn", "plus", "at", "dots",
    "dashes", "blanks", "colons", "spelled", "first_digit", "largest_part", "distinct_digits",
    "word_before", "word_after", "hint", "against",
)


def _found(text: str, pattern: str) -> str:
    """SQL: matches of a pattern as structs ``b`` (start), ``e`` (end), ``s``.

    The pieces between matches and the matches themselves tell all positions. Lengths
    are summed in blocks of about the root of their number, so a text with very many
    matches stays far from quadratic.
    """
    rx = "r'" + pattern.replace("'", r"\x27") + "'"
    return f"""transform(array(named_struct(
        'g', split({text}, {rx}, -1), 'm', regexp_extract_all({text}, {rx}, 0))),
      a -> transform(array(named_struct('g', a.g, 'm', a.m, 'k', int(ceil(sqrt(size(a.m)))),
          'n', zip_with(slice(a.g, 1, size(a.m)), a.m, (g, m) -> length(g) + length(m)))),
        b -> transform(array(transform(if(b.k = 0, array(), sequence(0, b.k - 1)),
            i -> aggregate(slice(b.n, i * b.k + 1, b.k), 0, (u, v) -> u + v))),
          c -> transform(b.m, (m, i) -> named_struct(
            'b', aggregate(slice(c, 1, i div b.k), 0, (u, v) -> u + v)
               + aggregate(slice(b.n, (i div b.k) * b.k + 1, i % b.k), 0, (u, v) -> u + v)
               + length(b.g[i]), 's', m)))[0])[0])[0]"""


def _spans(text: str, pattern: str) -> str:
    return f"transform({_found(text, pattern)}, x -> named_struct('b', x.b, 'e', x.b + length(x.s), 's', x.s))"


def _blanked(text: str, kind: str) -> str:
    """SQL: the text with valid matches of a base kind replaced by as many control marks."""
    rx = "r'" + BASE[kind] + "'"
    return f"""array_join(zip_with(split({text}, {rx}, -1), regexp_extract_all({text}, {rx}, 0),
      (g, x) -> concat(g, coalesce(if({CHECKS[kind]}, repeat('\\u0001', length(x)), x), ''))), '')"""


def base_spans(docs: DataFrame, *carry: str) -> DataFrame:
    """``carry`` columns, ``_text`` and per kind an array of base spans."""
    texts = computed_once(docs, *carry, _text=F.coalesce(F.col("text"), F.lit("")))
    looked = computed_once(texts, *carry, "_text", _digit=F.col("_text").rlike("[0-9]"))
    found = computed_once(
        looked,
        *carry,
        "_text",
        **{
            f"_all_{k}": F.expr(
                f"if({BASE_NEEDS[k].format(t='_text')}, {_spans('_text', BASE[k])}, array())"
            )
            for k in KINDS
        },
    )
    return found.select(
        *[F.col(f"`{c}`") for c in carry],
        "_text",
        *[
            F.expr(f"filter(_all_{k}, y -> exists(array(y.s), x -> {CHECKS[k]}))").alias(f"_{k}")
            for k in KINDS
        ],
    )


def _distinct(spans: str) -> str:
    """SQL: sorted spans without repeats, by their neighbours."""
    return f"""transform(array(sort_array({spans})),
      a -> filter(a, (y, i) -> i = 0 or a[greatest(i - 1, 0)] != y))[0]"""


def _blocks(items: str) -> str:
    """SQL: an array as blocks of about the root of its size, so that arrays grown within
    a block and then block by block stay far from quadratic."""
    k = f"greatest(1, int(ceil(sqrt(size({items})))))"
    count = f"greatest(0, size({items}) - 1) div {k}"
    return f"transform(sequence(0, int({count})), i -> slice({items}, i * {k} + 1, {k}))"


def _scan(items: str, kind: str, taken: str, cell: str, end: str, skipped: str) -> str:
    """SQL: ``to`` and ``m`` after a pass over sorted spans ``y`` with the last end ``c.to``.

    Where ``taken`` holds, ``cell`` is added and ``end`` is the new end, else ``skipped``.
    """
    empty = f"cast(array() as array<struct<{kind}>>)"
    inner = f"""aggregate(g, named_struct('to', a.to, 'm', {empty}),
        (c, y) -> if({taken}, named_struct('to', {end}, 'm', concat(c.m, array({cell}))),
                     named_struct('to', {skipped}, 'm', c.m)))"""
    return f"""aggregate({_blocks(items)},
      named_struct('to', 0, 'out', cast(array() as array<array<struct<{kind}>>>)),
      (a, g) -> transform(array({inner}),
        r -> named_struct('to', r.to, 'out', concat(a.out, array(r.m))))[0],
      a -> named_struct('to', a.to, 'm', flatten(a.out)))"""


def _around(start: str, chars: str) -> str:
    """SQL: at most CONTEXT characters from ``start``, out of the piece that holds them."""
    return f"substr(_pieces[({start}) div {PIECE}], ({start}) % {PIECE} + 1, {chars})"


def _features(kind: str) -> str:
    """SQL: a struct of FEATURES for a span ``y`` and the text in ``_pieces``."""
    digits = "translate(y.s, translate(y.s, '0123456789', ''), '')"
    parts = {
        "digits": "length(z.d)",
        "letters": r"length(regexp_replace(y.s, r'\P{L}', ''))",
        "chars": "length(y.s)",
        "groups": "size(z.p)",
        "longest_group": "coalesce(array_max(transform(z.p, p -> length(p))), 0)",
        "luhn": f"if(length(z.d) = 0 or length(z.d) > 24, 0, if({_luhn('z.d')}, 1, 0))",
        "plus": "if(y.s like '+%', 1, 0)",
        "at": "if(y.s like '%@%', 1, 0)",
        "dots": "length(y.s) - length(replace(y.s, '.', ''))",
        "dashes": "length(y.s) - length(replace(y.s, '-', ''))",
        "blanks": "length(y.s) - length(replace(y.s, ' ', ''))",
        "colons": "length(y.s) - length(replace(y.s, ':', ''))",
        "spelled": r"if(y.s rlike r'(?i)@|[\[(](?:at|dot)[\])]| dot ', 1, 0)",
        "first_digit": "coalesce(try_cast(left(z.d, 1) as int), -1)",
        "largest_part": "coalesce(array_max(transform(z.p, p -> int(left(p, 9)))), 0)",
        "distinct_digits": "size(array_distinct(split(z.d, '')))",
        "word_before": r"if(z.before rlike r'[\p{L}\p{N}_]$', 1, 0)",
        "word_after": r"if(z.after rlike r'^[\p{L}\p{N}_]', 1, 0)",
        "hint": f"if(z.before rlike '{HINTS[kind]}', 1, 0)",
        "against": f"if(z.before rlike '{AGAINST}', 1, 0)",
    }
    cells = ", ".join(f"'{name}', double({sql})" for name, sql in parts.items())
    return f"""transform(array(named_struct('d', {digits},
        'p', filter(split(y.s, '[^0-9]+'), p -> p != ''),
        'before', {_around(f"greatest(0, y.b - {CONTEXT})", f"least(y.b, {CONTEXT})")},
        'after', {_around("y.e", "1")})), z -> named_struct({cells}))[0]"""


def candidates(based: DataFrame, *carry: str) -> DataFrame:
    """Adds per kind an array of proposed spans with features ``f``, outside base spans."""
    rest = based
    for kind in KINDS:
        source = "_text" if kind == KINDS[0] else "_rest"
        kept = [*carry, "_text", *[f"_{k}" for k in KINDS]]
        rest = computed_once(
            rest,
            *kept,
            _rest=F.expr(f"if(size(_{kind}) = 0, {source}, {_blanked(source, kind)})"),
        )
    rest = rest.withColumn("_digit", F.col("_rest").rlike("[0-9]"))
    proposed = {
        kind: f"if({NEEDS[kind]}, "
        + _distinct(
            "concat("
            + ", ".join(_spans("_rest", rx) for k, rx in GENERATORS if k == kind)
            + ")"
        )
        + ", array())"
        for kind in KINDS
    }
    keep = [*carry, "_text", "_rest", *[f"_{k}" for k in KINDS]]
    raw = computed_once(
        rest, *keep, **{f"_raw_{k}": F.expr(sql) for k, sql in proposed.items()}
    )
    # pieces overlap by the context, so a look at one does not walk through the whole text
    any_raw = " + ".join(f"size(_raw_{k})" for k in KINDS)
    pieces = (
        f"if({any_raw} = 0, array(), transform(sequence(0, length(_rest) div {PIECE}),"
        f" i -> substr(_rest, int(i) * {PIECE} + 1, {PIECE + CONTEXT})))"
    )
    raw = computed_once(raw, *keep, *[f"_raw_{k}" for k in KINDS], _pieces=F.expr(pieces))
    return raw.select(
        *[F.col(f"`{c}`") for c in keep],
        *[
            F.expr(
                f"transform(_raw_{k}, y -> named_struct('b', y.b, 'e', y.e, 'f', {_features(k)}))"
            ).alias(f"_more_{k}")
            for k in KINDS
        ],
    )


@dataclass(frozen=True)
class Detector:
    models: dict[str, boosting.Boosted]
    thresholds: dict[str, float]  # margins


# formats of the examples: '#' is a digit, 'B' a number of 0 to 255, 'L' a letter, 'C' a
# card number and 'W' one with a wrong check digit; a sign behind these groups the digits
TRUE_FORMATS = {
    "email": ("LLLL at LLLLL dot LL", "LLL.LLLL[at]LLLLLL[dot]LLL", "LLLL (at) LLLLL (dot) LLL",
              "LLLéL@LLLL.LL", "LLLé@LLLLL.LL", "LLLLL @ LLLLL.LLL", "LLL.LLL (at) LLLLL.LL",
              "LLLL at LLLLL[dot]LLL", "LLLL at LLLL.LLLLL dot LLL", "LLLL AT LLLLL DOT LLL",
              "LLLL[AT]LLLLL[DOT]LL"),
    "ip": ("B[.]B[.]B[.]B", "B . B . B . B", "B(.)B(.)B(.)B",
           "2001:####:####:#:#:#:####:####", "fe80::####:####:####:####"),
    "card": ("C C", "2024 C", "C  ", "C.", "C/", "C 7"),
    "phone": ("(###) ###-####", "###-###-####", "### ### ####", "0049 ### #######",
              "030 ########", "01 ## ## ## ##", "(###)###-####", "###.###.####"),
}
FALSE_FORMATS = {
    "email": ("LLLL at LLLLL. LL LLLL", "LLL at LL.LLL LL", "LL at the LLLLL. The LLL",
              "LLLL at LLLL. Then LL", "# @ #.##", "LLLL @ LLLL. LLLL LL", "## @ ##.##",
              "LLLL @ LLL. LL LLL"),
    "ip": ("9##.B.8##.B", "##:##:##:##", "1.0.0.#.#.#", "##:##:##:##:##", "3##.4##.5##.6##"),
    "card": ("W", "W W", "2024 W", "W  ", "W.", "W/", "W 7", "202#########01"),
    "phone": ("##########", "202#-0#-## ####", "#.###.###,##", "### ### #######",
              "0.### ####", "01/02/20## 10"),
}
EXAMPLES = 6000

_FILLERS = (
    "the man was in a house and then it came from there", "de la casa que no es para",
    "und der Mann ist nicht zu Hause", "le jour est dans une autre ville", "",
)
_FRONTS = {
    "email": ("mail", "contact me:", "write to", "", ""),
    "ip": ("host", "from", "server", "", ""),
    "card": ("card", "paid with visa", "Karte", "", ""),
    "phone": ("call", "tel.", "phone:", "", ""),
}
_WRONG_FRONTS = ("order", "invoice no.", "version", "ref", "isbn", "", "", "")


def _quoted(values) -> str:
    return "array(" + ", ".join("'" + v.replace("'", "\\'") + "'" for v in values) + ")"


def examples(spark: SparkSession, count: int = EXAMPLES) -> DataFrame:
    """``kind``, ``label`` and ``text``: formats filled by hashes of the row number."""

    def draw(salt: str, below: int) -> str:
        return f"int(pmod(xxhash64(id, '{salt}'), {below}))"

    def pick(values, salt: str) -> str:
        return f"element_at({_quoted(values)}, {draw(salt, len(values))} + 1)"

    front15 = "concat('4', lpad(string(pmod(xxhash64(id, {k}, 'card'), 100000000000000L)), 14, '0'))"

    def card(k: str, wrong: int) -> str:
        fifteen = front15.replace("{k}", k)
        check = "transform(array({n}), n -> aggregate(sequence(1, 15), 0, (a, i) -> a + if(i % 2 = 1,"
        check += " int(substr('0246813579', int(substr(n, i, 1)) + 1, 1)), int(substr(n, i, 1)))))[0]"
        last = f"(10 - {check.replace('{n}', fifteen)} % 10 + {wrong}) % 10"
        return f"concat({fifteen}, {last})"

    def grouped(number: str, sign: str) -> str:
        return f"regexp_replace({number}, '([0-9]{{4}})(?=[0-9])', concat('$1', {sign}))"

    rows = spark.range(count)
    parts = []
    for kind in KINDS:
        for label, formats in ((1, TRUE_FORMATS[kind]), (0, FALSE_FORMATS[kind])):
            fronts = _FRONTS[kind] if label else _WRONG_FRONTS + _FRONTS[kind]
            parts.append((kind, label, formats, fronts))
    total = len(parts)
    fmt = " ".join(
        f"when {i} then {pick(p[2], 'format')}" for i, p in enumerate(parts)
    )
    front = " ".join(f"when {i} then {pick(p[3], 'front')}" for i, p in enumerate(parts))
    kind = " ".join(f"when {i} then '{p[0]}'" for i, p in enumerate(parts))
    label = " ".join(f"when {i} then {p[1]}" for i, p in enumerate(parts))
    drawn = rows.selectExpr(
        "id",
        f"case id % {total} {kind} end as kind",
        f"case id % {total} {label} end as label",
        f"case id % {total} {fmt} end as fmt",
        f"case id % {total} {front} end as front",
        f"{pick(_FILLERS, 'a')} as before",
        f"{pick(_FILLERS, 'b')} as after",
    )
    sign = "case when fmt like '%.' then '.' when fmt like '%/' then '/'"
    sign += " when fmt like '%  ' then '  ' else '' end"
    plain = "rtrim(regexp_replace(fmt, '[./]$| +$', ''))"
    filled = f"""array_join(transform(split(if(kind = 'card', {plain}, fmt), ''), (c, i) -> case c
        when '#' then string(pmod(xxhash64(id, i, 'digit'), 10))
        when 'B' then string(pmod(xxhash64(id, i, 'byte'), 256))
        when 'L' then substr('abcdefghijklmnopqrstuvwxyz', int(pmod(xxhash64(id, i, 'letter'), 26)) + 1, 1)
        when 'C' then {grouped(card('i', 0), sign)}
        when 'W' then {grouped(card('i', 3), sign)}
        else c end), '')"""
    return drawn.selectExpr(
        "kind", "label", f"concat_ws(' ', before, front, {filled}, after) as text", "id"
    )


def fit(spark: SparkSession, count: int = EXAMPLES) -> Detector:
    """One ensemble per kind from ``count`` examples; every other one sets the threshold.

    A threshold is the margin with the best F-0.5 score, which counts precision twice, on
    the held-out examples; the features of a few spans per example come to the driver.
    """
    shown = candidates(base_spans(examples(spark, count), "kind", "label", "id"), "kind", "label", "id")
    models, thresholds = {}, {}
    rows = shown.selectExpr(
        "kind", "label", "id",
        "case kind " + " ".join(f"when '{k}' then _more_{k}" for k in KINDS) + " end as spans",
    ).selectExpr("kind", "label", "id", "inline(spans)").collect()
    for kind in KINDS:
        own = sorted((r for r in rows if r["kind"] == kind), key=lambda r: (r["id"], r["b"], r["e"]))
        x = np.asarray([list(r["f"]) for r in own], dtype=np.float64).reshape(len(own), -1)
        y = np.asarray([r["label"] for r in own], dtype=np.float64)
        held = np.asarray([r["id"] // (2 * len(KINDS)) % 2 == 1 for r in own], dtype=bool)
        models[kind] = boosting.fit(x[~held], y[~held])
        margin = models[kind].margin(x[held])
        order = np.argsort(-margin, kind="stable")
        hits = np.cumsum(y[held][order])
        score = 1.25 * hits / np.maximum(0.25 * y[held].sum() + np.arange(1, len(order) + 1), 1)
        least = margin[order][int(score.argmax())] if hits.any() else np.inf
        below = margin[margin < least]
        # halfway to the next example keeps the cut away from either
        thresholds[kind] = float(np.round((least + below.max()) / 2 if len(below) else least, 6))
    return Detector(models, thresholds)


_fitted: dict[str, Detector] = {}


def default_detector(spark: SparkSession) -> Detector:
    """The detector of this application, fitted once; its examples do not depend on data."""
    name = spark.sparkContext.applicationId
    if name not in _fitted:
        _fitted[name] = fit(spark)
    return _fitted[name]


def detected(docs: DataFrame, detector: Detector, *carry: str) -> DataFrame:
    """``carry``, ``_text``, the base spans per kind and ``_all``: every span in order.

    ``_all`` holds structs ``b``, ``k`` (place of the kind), ``e`` sorted by these.
    """
    based = base_spans(docs, *carry)
    shown = candidates(based, *carry)
    keep = [*carry, "_text", *[f"_{k}" for k in KINDS]]
    chosen = []
    for place, kind in enumerate(KINDS):
        margin = detector.models[kind].sql([f"y.f.{name}" for name in FEATURES])
        limit = detector.thresholds[kind]
        test = f"({margin}) >= {limit:.6f}D" if np.isfinite(limit) else "false"
        chosen.append(
            f"transform(filter(_more_{kind}, y -> {test}),"
            f" y -> named_struct('b', y.b, 'w', -y.e, 'k', {place}))"
        )
    picked = computed_once(
        shown, *keep, _picked=F.expr(f"sort_array(concat({', '.join(chosen)}))")
    )
    free = _scan(
        "_picked",
        "b: int, k: int, e: int",
        taken="y.b >= c.to",
        cell="named_struct('b', y.b, 'k', y.k, 'e', -y.w)",
        end="-y.w",
        skipped="c.to",
    )
    base = ", ".join(
        f"transform(_{kind}, y -> named_struct('b', y.b, 'k', {place}, 'e', y.e))"
        for place, kind in enumerate(KINDS)
    )
    return computed_once(picked, *keep, _all=F.expr(f"sort_array(concat({base}, {free}.m))"))


def _listed(spans: str) -> str:
    kinds = _quoted(KINDS)
    return (
        f"array_join(transform({spans}, y -> concat_ws(':', {kinds}[y.k], y.b, y.e)), ',')"
    )


def personal_data(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """``doc_id``, base counts ``n_<kind>``, ``base_sha256`` and ``spans`` of every document."""
    detector = detector or default_detector(docs.sparkSession)
    base = ", ".join(
        f"transform(_{kind}, y -> named_struct('b', y.b, 'k', {place}, 'e', y.e))"
        for place, kind in enumerate(KINDS)
    )
    found = detected(docs, detector, "doc_id")
    return found.select(
        "doc_id",
        *[F.size(f"_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.expr(_listed(f"sort_array(concat({base}))")), 256).alias("base_sha256"),
        F.expr(_listed("_all")).alias("spans"),
    )


def redacted(docs: DataFrame, detector: Detector | None = None) -> DataFrame:
    """The rows of ``docs`` with each span replaced by its kind in square brackets.

    Overlapping spans become one mark, of the kind that begins first; ``n_chars`` follows.
    """
    detector = detector or default_detector(docs.sparkSession)
    whole, names = set_aside(docs, "text")
    found = detected(whole, detector, *names.values())
    marks = _quoted([f"[{k.upper()}]" for k in KINDS])
    merged = _scan(
        "_all",
        "f: int, b: int, k: int",
        taken="y.b >= c.to",
        cell="named_struct('f', c.to, 'b', y.b, 'k', y.k)",
        end="y.e",
        skipped="greatest(c.to, y.e)",
    )
    block = f"""transform(array(named_struct('f', g[0].f,
        's', substr(_text, g[0].f + 1, g[size(g) - 1].b - g[0].f))), h -> array_join(transform(g,
          y -> concat(substr(h.s, y.f - h.f + 1, y.b - y.f), {marks}[y.k])), ''))[0]"""
    pieces = f"""transform(array({merged}), r -> concat(
        array_join(transform({_blocks("r.m")}, g -> {block}), ''), substr(_text, r.to + 1)))[0]"""
    old = F.col(names["text"])
    changed = computed_once(
        found,
        *names.values(),
        _new=F.when(F.size("_all") == 0, old).otherwise(F.expr(pieces)),
    )
    new = {"text": F.col("_new")}
    if "n_chars" in names:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.col("_new").eqNullSafe(old), F.col(names["n_chars"]))
        new["n_chars"] = counted.otherwise(F.length("_new")).cast(kind)
    return put_back(changed, names, **new)
