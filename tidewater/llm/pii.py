"""Personal data in texts: candidate spans, boosted trees over their format and context, calibrated thresholds.

Two generators a kind work on every whole text. The base one follows a strict pattern, and its
matches that pass the kind's test (parts of an address, check digit, number of digits) are
always spans. The wide one proposes whatever could be of the kind, such as spelled-out mail
addresses or numbers with other separators; its proposals overlap base spans and each other.

A proposal with a base span inside is an example for its kind; one that cannot be of the kind
(failed check digit, part above 255, no domain, piece of a longer token) is one against. Both
are counted by their features over all documents, and trees are boosted on these counts, of
which there are at most as many as combinations of feature values. Four of five documents train
the trees; on the fifth the lowest threshold is found above which nearly all are for the kind.
The other proposals, which neither rule decides, become spans when they reach it. Without enough
examples on both sides a kind adds nothing. What a span is depends on its document alone, given
the model.

Positions count code points; the end is exclusive. A null text counts as empty and has no spans.
Rows without an id, and rows that repeat one, are judged each by its own text. Texts of any
length are searched whole, in time in proportion to their length. An empty table gives an empty
result. Extra columns are not touched. All work on texts is done by Spark's own functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.tables import fold, keep

KINDS = ("email", "ip", "card", "phone")

# Trees of a kind, their depth, and how far each is trusted.
TREES, DEPTH, RATE = 20, 3, 0.3
# Share of right proposals above a threshold, and examples of either side that a kind needs.
PRECISION, EXAMPLES = 0.98, 20
# Code points before a proposal that are searched for cue words.
CONTEXT = 24
# Entries whose running sums are made in one go.
_RUN = 256

# The base patterns. The guards behind the first character, and possessive repeats,
# only keep the search from trying one run of characters again from each of its places.
_LOCAL = "A-Za-z0-9._%+-"
_DOMAIN = r"[A-Za-z0-9-]++"
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@{_DOMAIN}(?:\.{_DOMAIN})++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:@|\x20?[(\[{]\x20?(?:at|AT|@)\x20?[)\]}]\x20?|\x20(?:at|AT|@)\x20)"
_DOT = r"(?:\.|\x20?[(\[{]\x20?(?:dot|DOT|\.)\x20?[)\]}]\x20?|\x20(?:dot|DOT)\x20)"
_POINT = r"\x20?[(\[{]?\x20?(?:\.|dot)\x20?[)\]}]?\x20?"
WIDE = {
    "email": rf"[{_LOCAL}](?<![{_LOCAL}]{{2}})[{_LOCAL}]*+{_AT}{_DOMAIN}(?:{_DOT}{_DOMAIN})*+",
    "ip": rf"[0-9](?<![0-9]{{2}})[0-9]*+(?:{_POINT}[0-9]++)++",
    "card": r"[0-9](?:[\x20._/-]{0,2}[0-9])++",
    "phone": r"[+(]?[0-9][\x20().0-9/-]*[0-9]",
}
_QUAD = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
# What a text must hold for a pattern to match at all: quickly seen.
_NEEDS = {
    "b_email": "@", "b_ip": r"[0-9]\.[0-9]", "b_card": "[0-9]", "b_phone": r"\+[0-9]",
    "w_email": r"@|[\x20(\[{](?:at|AT)[\x20)\]}]", "w_ip": "[0-9]", "w_card": "[0-9]", "w_phone": "[0-9]",
}
# Words that announce a kind.
CUES = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|host|server|addr|login",
    "card": "card|visa|pay|credit|karte|carte|tarjeta",
    "phone": "tel|phone|call|mobile|fax|tél|móvil|handy",
}
FEATURES = ("valid", "digits", "separators", "before", "after", "cue", "groups", "longest")

_DIGIT_STEPS = (1, 4, 7, 9, 11, 13, 16, 20)
_LENGTH_STEPS = (2, 3, 4, 5, 8)


def _running(sizes: Column) -> Column:
    """Sums of the entries before each entry; long arrays in runs, so that no array grows entry by entry."""

    def before(values: Column, start: Column) -> Column:
        empty = F.struct(start.alias("sum"), F.array().cast("array<bigint>").alias("out"))
        add = lambda acc, x: F.struct(
            (acc["sum"] + x).alias("sum"), F.concat(acc["out"], F.array(acc["sum"])).alias("out")
        )
        return F.aggregate(values, empty, add, lambda acc: acc["out"])

    zero = F.lit(0).cast("bigint")
    runs = F.transform(
        F.sequence(F.lit(0), ((F.size(sizes) - 1) / _RUN).cast("int")), lambda i: F.slice(sizes, i * _RUN + 1, F.lit(_RUN))
    )
    totals = F.transform(runs, lambda run: F.aggregate(run, zero, lambda acc, x: acc + x))
    sums = F.flatten(F.zip_with(runs, before(totals, zero), before))
    return F.when(F.size(sizes) > 0, sums).otherwise(F.array().cast("array<bigint>"))


def _sizes(found: Column, gaps: Column) -> Column:
    """Length of each match and of the text before it."""
    return F.zip_with(found, F.slice(gaps, 1, F.size(found)), lambda f, g: (F.length(f) + F.length(g)).cast("bigint"))


def _located(found: Column, gaps: Column, sizes: Column) -> Column:
    """Matches with their place and surroundings, from the matches and the text between them."""
    n = F.size(found)
    pairs = F.arrays_zip(
        found.alias("text"),
        F.slice(gaps, 1, n).alias("gap"),
        F.slice(gaps, 2, n).alias("next"),
        F.concat(F.array(F.lit("")), found).alias("last"),
        _running(sizes).alias("sum"),
    )
    return F.transform(
        F.slice(pairs, 1, n),
        lambda p: F.struct(
            (p["sum"] + F.length(p["gap"])).alias("start"),
            (p["sum"] + F.length(p["gap"]) + F.length(p["text"])).alias("end"),
            p["text"].alias("text"),
            F.right(F.concat(p["last"], p["gap"]), F.lit(CONTEXT)).alias("before"),
            F.left(p["next"], F.lit(1)).alias("after"),
            F.regexp_replace(p["text"], "[^0-9]", "").alias("number"),
        ),
    )


def _luhn(number: Column) -> Column:
    n = F.length(number)

    def add(acc: Column, i: Column) -> Column:
        twice = number.substr(n - i + 1, F.lit(1)).cast("int") * (1 + F.pmod(i - 1, F.lit(2)))
        return acc + twice - F.when(twice > 9, 9).otherwise(0)

    return F.pmod(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add), F.lit(10)) == 0


def _parts_fit(text: Column, separator: str = r"\.") -> Column:
    """Every part of an address is at most 255."""
    short = lambda p: F.regexp_replace(p, "^0+", "")
    return F.forall(F.split(text, separator), lambda p: (F.length(short(p)) < 3) | ((F.length(short(p)) == 3) & (short(p) <= "255")))


def _passes(kind: str, m: Column) -> Column:
    """The test of a base match."""
    n = F.length(m["number"])
    if kind == "ip":
        return _parts_fit(m["text"])
    if kind == "card":
        return F.when(n.between(16, 19), _luhn(m["number"])).otherwise(False)
    return n.between(8, 15) if kind == "phone" else F.lit(True)


def _bucket(n: Column, steps: tuple[int, ...]) -> Column:
    out = F.lit(len(steps))
    for i in range(len(steps) - 1, -1, -1):
        out = F.when(n < steps[i], i).otherwise(out)
    return out


def _side(c: Column) -> Column:
    """What kind of character stands beside a proposal."""
    return (
        F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[\p{L}_@]"), 2).when(c.rlike("[0-9]"), 3).when(c.rlike(r"[()\[\]\"'<>:=,;]"), 4).otherwise(5)
    )


def _separators(text: Column) -> Column:
    rest = F.regexp_replace(text, "[A-Za-z0-9@]", "")
    return (
        F.when(rest == "", 0)
        .when(rest.rlike(r"^\x20+$"), 1)
        .when(rest.rlike("^-+$"), 2)
        .when(rest.rlike(r"^\.+$"), 3)
        .when(rest.rlike(r"[\[\]{}]"), 5)
        .otherwise(4)
    )


def _described(kind: str, m: Column) -> Column:
    """A proposal with its features and, where a rule decides, its label."""
    text, number, n = m["text"], m["number"], F.length(m["number"])
    groups = F.filter(F.split(text, "[^A-Za-z0-9]+"), lambda g: g != "")
    side = (_side(F.right(m["before"], F.lit(1))), _side(m["after"]))
    piece = side[0].isin(2, 3) | side[1].isin(2, 3)
    if kind == "email":
        valid = F.coalesce(F.try_element_at(groups, F.lit(-1)), F.lit("")).rlike("^[A-Za-z]{2,24}$")
        for_it = text.rlike(BASE["email"])
        against = ~valid | ~text.rlike(_AT + _DOMAIN + _DOT)
    elif kind == "ip":
        parts = F.regexp_replace(text, "[^0-9]+", ".")
        valid = _parts_fit(parts) & (F.size(F.split(parts, r"\.")) == 4) & ~parts.rlike("[0-9]{4}")
        for_it = valid & text.rlike(r"^[0-9.]+$")
        against = ~valid | piece
    elif kind == "card":
        valid = F.when(n.between(13, 19), _luhn(number)).otherwise(False)
        for_it = valid & (n >= 16) & text.rlike(f"^{BASE['card']}$")
        against = ~valid | piece | text.rlike(_QUAD)
    else:
        valid = n.between(7, 15)
        for_it = text.startswith("+") & n.between(8, 15)
        date = r"^[0-9]{1,4}[./-][0-9]{1,2}[./-][0-9]{1,4}$"
        against = (n < 7) | (n > 12) | piece | text.startswith("+") | text.rlike(_QUAD) | text.rlike(date)
    # A base card inside a longer proposal is a span already and says nothing about the rest.
    taken = text.rlike("[0-9](?:[\\x20-]?[0-9]){15,}") if kind == "card" else F.lit(False)
    label = F.when(for_it, 1).when(against, 0).when(taken, -1)
    values = {
        "valid": F.when(valid, 1).otherwise(0),
        "digits": _bucket(n, _DIGIT_STEPS),
        "separators": _separators(text),
        "before": side[0],
        "after": side[1],
        "cue": F.when(F.lower(m["before"]).rlike(CUES[kind]), 1).otherwise(0),
        "groups": F.least(F.size(groups), F.lit(6)),
        "longest": _bucket(F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), _LENGTH_STEPS),
    }
    return F.struct(m["start"].alias("start"), m["end"].alias("end"), label.alias("label"), *[values[f].cast("int").alias(f) for f in FEATURES])


def proposals(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``(id, base_<kind>, wide_<kind>, ...)``: base spans and described proposals of every row."""
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    patterns = {f"{side}_{k}": p for side, ps in (("b", BASE), ("w", WIDE)) for k, p in ps.items()}

    def searched(name: str, pattern: str) -> list[Column]:
        """Matches, and the text between them; none, and the whole text, where there is nothing to search for."""
        none, whole = F.array().cast("array<string>"), F.array("text")
        may = F.col("text").rlike(_NEEDS[name])
        found = F.when(may, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none)
        return [found.alias(name), F.when(may, F.split("text", pattern, -1)).otherwise(whole).alias(f"{name}_gaps")]

    # Steps of their own, so that nothing is computed again where it is used twice.
    found = rows.select("id", *[c for name, p in patterns.items() for c in searched(name, p)])
    sized = found.select("*", *[_sizes(F.col(n), F.col(f"{n}_gaps")).alias(f"{n}_sizes") for n in patterns])
    placed = sized.select("id", *[_located(F.col(n), F.col(f"{n}_gaps"), F.col(f"{n}_sizes")).alias(n) for n in patterns])
    span = lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))

    def passed(kind: str) -> Column:
        return F.transform(F.filter(F.col(f"b_{kind}"), lambda m: _passes(kind, m)), span).alias(f"base_{kind}")

    def described(kind: str) -> Column:
        return F.transform(F.col(f"w_{kind}"), lambda m: _described(kind, m)).alias(f"wide_{kind}")

    return placed.select("id", *[passed(k) for k in KINDS], *[described(k) for k in KINDS])


# A tree is a leaf's value or (feature, limit, tree up to the limit, tree beyond it).
Tree = float | tuple


@dataclass(frozen=True)
class Model:
    """Boosted trees of a kind over the features, and the score from which a proposal is a span."""

    bias: float
    trees: list[Tree]
    threshold: float


def _value(tree: Tree, features: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if features[tree[0]] <= tree[1] else tree[3]
    return tree


def grow(cells: list[tuple[tuple[int, ...], float, float]], depth: int) -> Tree:
    """Tree of the best splits of cells ``(features, gradient, curvature)``."""
    g, h = sum(c[1] for c in cells), sum(c[2] for c in cells)
    best = (1e-6, None, None)
    if depth and len(cells) > 1:
        for j in range(len(cells[0][0])):
            by_value: dict[int, list[float]] = {}
            for features, cg, ch in cells:
                own = by_value.setdefault(features[j], [0.0, 0.0])
                own[0] += cg
                own[1] += ch
            left_g = left_h = 0.0
            for value in sorted(by_value)[:-1]:
                left_g += by_value[value][0]
                left_h += by_value[value][1]
                gain = left_g**2 / (left_h + 1) + (g - left_g) ** 2 / (h - left_h + 1) - g**2 / (h + 1)
                if gain > best[0]:
                    best = (gain, j, value)
    if best[1] is None:
        return RATE * g / (h + 1)
    _, j, value = best
    sides = [c for c in cells if c[0][j] <= value], [c for c in cells if c[0][j] > value]
    return (j, value, *(grow(side, depth - 1) for side in sides))


def boost(cells: list[tuple[tuple[int, ...], int, int]]) -> tuple[float, list[Tree]]:
    """Bias and trees of a logistic model of cells ``(features, examples for, examples against)``."""
    bias = math.log(sum(c[1] for c in cells) / sum(c[2] for c in cells))
    scores, trees = [bias] * len(cells), []
    for _ in range(TREES):
        p = [1 / (1 + math.exp(-s)) for s in scores]
        tree = grow([(f, a - (a + b) * q, (a + b) * q * (1 - q)) for (f, a, b), q in zip(cells, p)], DEPTH)
        trees.append(tree)
        scores = [s + _value(tree, c[0]) for s, c in zip(scores, cells)]
    return bias, trees


def calibrate(bias: float, trees: list[Tree], held: list[tuple[tuple[int, ...], int, int]]) -> float:
    """Lowest score above which, among held-out examples, nearly all are for the kind; infinite if there is none."""
    scored = sorted(((bias + sum(_value(t, f) for t in trees), a, b) for f, a, b in held), key=lambda s: -s[0])
    good = bad = 0
    threshold = math.inf
    for i, (score, a, b) in enumerate(scored):
        good, bad = good + a, bad + b
        whole = i + 1 == len(scored) or scored[i + 1][0] < score
        if whole and good and good >= PRECISION * (good + bad):
            threshold = score
    return threshold


def train(proposed: DataFrame) -> dict[str, Model]:
    """Models of the kinds that have examples enough, from counts over all rows of :func:`proposals`."""
    tagged = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"wide_{k}").alias("wide")) for k in KINDS])
    rows = proposed.select((fold("id") == 0).alias("held"), F.inline(tagged)).select("held", "kind", F.inline("wide"))
    counts = rows.where(F.col("label") >= 0).groupBy("kind", "held", *FEATURES).agg(
        F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")
    )
    cells: dict[tuple[str, bool], list] = {}
    for r in counts.orderBy("kind", "held", *FEATURES).collect():
        cells.setdefault((r["kind"], bool(r["held"])), []).append((tuple(r[f] for f in FEATURES), r["good"], r["bad"]))
    models = {}
    for kind in KINDS:
        taught, held = cells.get((kind, False), []), cells.get((kind, True), [])
        if min(sum(c[1] for c in taught), sum(c[2] for c in taught)) >= EXAMPLES:
            bias, trees = boost(taught)
            threshold = calibrate(bias, trees, held)
            if threshold < math.inf:
                models[kind] = Model(bias, trees, threshold)
    return models


def score(model: Model, proposal: Column) -> Column:
    def column(tree: Tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(tree)
        return F.when(proposal[FEATURES[tree[0]]] <= tree[1], column(tree[2])).otherwise(column(tree[3]))

    total = F.lit(model.bias)
    for tree in model.trees:
        total = total + column(tree)
    return total


def spans(proposed: DataFrame, models: dict[str, Model]) -> DataFrame:
    """``(id, base_<kind>, spans_<kind>, ...)``: base spans, and all spans by start."""
    span = lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))

    def added(kind: str) -> Callable[[Column], Column]:
        return lambda m: m["label"].isNull() & (score(models[kind], m) >= models[kind].threshold - 1e-9)

    out = []
    for kind in KINDS:
        every = F.col(f"base_{kind}")
        if kind in models:
            every = F.array_sort(F.array_union(every, F.transform(F.filter(F.col(f"wide_{kind}"), added(kind)), span)))
        out.append(every.alias(f"spans_{kind}"))
    return proposed.select("id", *[f"base_{k}" for k in KINDS], *out)


def find(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Spans of every row, by a model of the same rows."""
    proposed = keep(proposals(docs, id_column, text_column))
    return spans(proposed, train(proposed)).withColumnRenamed("id", id_column)


def redact(text: Column, found: Column) -> Column:
    """``text`` with each of the spans, given as ``(start, end, kind)``, replaced by its kind in brackets.

    Of overlapping spans the first to start, of those the longest, gives the name, and all are covered.
    """
    order = lambda a, b: F.when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(b["end"] - a["end"])).cast("int")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] >= acc["at"], F.concat(text.substr((acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit("["), s["kind"], F.lit("]")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.coalesce(gap, F.lit(""))).alias("out"))

    rest = lambda acc: F.concat(acc["out"], text.substr((acc["at"] + 1).cast("int"), F.length(text)))
    return F.aggregate(F.array_sort(found, order), start, step, rest)


def digests(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Counts and hash of the base spans, and all spans as text."""

    def named(prefix: str, kind: str) -> Column:
        return F.transform(f"{prefix}_{kind}", lambda s: F.concat_ws(":", F.lit(kind), s["start"], s["end"]))

    def text(prefix: str) -> Column:
        return F.array_join(F.concat(*[named(prefix, k) for k in KINDS]), ",")

    sizes = lambda prefix: sum((F.size(f"{prefix}_{k}") for k in KINDS), F.lit(0))
    return found.select(
        id_column,
        *[F.size(f"base_{k}").cast("bigint").alias(f"n_{k}") for k in KINDS],
        F.sha2(text("base"), 256).alias("base_sha256"),
        text("spans").alias("spans"),
        (sizes("spans") - sizes("base")).cast("bigint").alias("n_added"),
    )
