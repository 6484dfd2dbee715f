"""Personal data in texts, by DataFrame functions only.

Base rules find e-mail addresses, IP addresses, payment cards and telephone numbers by
pattern and check. High-recall generators propose further, overlapping spans (other
separators, bracketed dots, numbers without a country code). Boosted trees score each
proposal by format and context; a threshold that is calibrated on the labelled proposals
selects what is added, and of added spans that overlap each other the best stands. Base spans always stay.

Learning: a proposal that covers just a base span is a positive, and so is one of another form that passes its kind's check
behind a word that announces it; one that lies in a word, meets
a base span of another kind or fails the kind's check is a negative; the rest is unlabelled. Features are small integers, so all
labelled proposals of the whole table fit into one grouped count per feature combination
(their number is bounded by the features' ranges); the driver grows the trees from those
counts, and scoring is one column expression.

Positions: ``split`` gives the gaps and ``regexp_extract_all`` the hits of a pattern, so
the lengths of both give every hit's place in code points.

Defined results for odd input: null text is the empty text (no spans; digest of the
empty string); rows with equal or null ids give a row each; an empty table gives no
rows; ``scan`` passes extra columns on; ones called like its own two get a leading underscore. Whole texts are read, however long;
equal scores are settled by length, then place.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fresh, table, with_room

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
#: Possessive forms of the base patterns. Their matches are the same, as what follows a repeated
#: part is never in its class; they take linear time and constant stack on long runs.
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT = r"(?:\s?+(?:\[at\]|\(at\)|\{at\})\s?+|@|＠)"
_DOT = r"(?:\s?+(?:\[dot\]|\(dot\)|\[\.\]|\(\.\))\s?+|\x20dot\x20|\.|．)"
WIDE = {
    "email": rf"(?<!{LOCAL}){LOCAL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:(?:\x20?+(?:\[\.\]|\(\.\)|\.)\x20?+)[0-9]++){3}+(?![0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:[\x20./_-]{0,2}+[0-9]{3,6}+){2,4}+(?![0-9])",
    "phone": r"(?<![0-9+])\+?+\(?+[0-9][0-9().\x20/-]{5,22}[0-9](?![0-9])",
}
#: What a text must hold for a kind's patterns to be tried at all: every match of either pattern holds it.
NEEDS = {"email": r"[@＠]|[\[({]at[\])}]", "ip": r"[0-9]\x20?[\[(]?\.", "card": r"[0-9][\x20-]?[0-9]", "phone": r"[0-9]"}
_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?)?"
_CUES = {
    "email": r"(?i)e-?mail|contact|write|@|courriel|correo",
    "ip": r"(?i)\bip\b|host|server|addr|login|network",
    "card": r"(?i)card|visa|master|amex|credit|karte|carte|tarjeta|payment",
    "phone": r"(?i)phone|tel|call|mobile|fax|cell|appel|anruf|tel[eé]fono",
}
CONTEXT = 24
PRECISION = 0.98


# ---------------------------------------------------------------- spans


def spans(text: Column, pattern: str, needs: str) -> Column:
    """array<struct<start, end, hit>> of a pattern's leftmost non-overlapping matches."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    empty = F.expr("cast(array() as array<struct<start:int,end:int,hit:string>>)")
    pairs = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"))
    start = F.struct(F.lit(0).alias("at"), empty.alias("found"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["gap"])
        end = begin + F.char_length(x["hit"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(span)).alias("found"))

    # the last gap has no hit
    found = F.aggregate(F.slice(pairs, F.lit(1), F.size(hits)), start, step, lambda acc: acc["found"])
    return F.when(text.rlike(needs) & text.rlike(pattern), found).otherwise(empty)


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def passes(kind: str, hit: Column) -> Column:
    """The kind's check of a base hit."""
    d = digits(hit)
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.char_length(d).between(16, 19) & F.call_function("luhn_check", d)
    if kind == "phone":
        return F.char_length(d).between(8, 15)
    return F.lit(True)


def base_spans(text: Column) -> dict[str, Column]:
    def of(kind: str) -> Column:
        return F.filter(spans(text, BASE[kind], NEEDS[kind]), lambda x: passes(kind, x["hit"]))

    return {k: of(k) for k in KINDS}


def of_kind(found: Column, kind: str) -> Column:
    return F.filter(found, lambda x: x["kind"] == kind)


# ---------------------------------------------------------------- proposals


FEATURES = ("kind", "n_digits", "groups", "separator", "plain", "check", "before", "after", "cue", "size", "meets")


def _edge(c: Column) -> Column:
    """The class of a neighbouring character: 0 none, 1 space, 2 letter, 3 digit, 4 other."""
    return (
        F.when(c == "", 0).when(c.rlike(r"^\s"), 1).when(c.rlike(r"^\p{L}"), 2).when(c.rlike("^[0-9]"), 3).otherwise(4)
    )


def _features(kind: str, text: Column, span: Column, meets: Column) -> Column:
    hit, d = span["hit"], digits(span["hit"])
    before = F.substring(text, F.greatest(span["start"] - CONTEXT, F.lit(0)) + 1, F.least(span["start"], F.lit(CONTEXT)))
    after = F.substring(text, span["end"] + 1, F.lit(1))
    n_digits = F.least(F.char_length(d), F.lit(24))
    separator = (
        F.when(~hit.rlike("[^0-9+]"), 0).when(hit.rlike(r"[\[({]\s*(?:at|dot|\.)"), 5).when(hit.rlike(r"[/_]"), 4)
        .when(hit.rlike(r"\."), 3).when(hit.rlike(r"-"), 2).otherwise(1)
    )
    if kind == "email":
        check = hit.rlike(r"[.．\])\x20][A-Za-z]{2,24}$").cast("int")
    elif kind == "ip":
        check = F.regexp_replace(hit, r"[^0-9.]", "").rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$").cast("int")
    elif kind == "card":
        check = (n_digits.between(13, 19) & F.call_function("luhn_check", d)).cast("int")
    else:
        check = n_digits.between(8, 15).cast("int") + (hit.startswith("+")).cast("int")
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        n_digits.alias("n_digits"),
        F.least(F.size(F.split(hit, "[^0-9]+")), F.lit(8)).alias("groups"),
        separator.alias("separator"),
        hit.rlike(BASE[kind].replace(r"\G|", "") if kind != "email" else "^[^\\s\\[({]+@[^\\s\\[({]+$").cast("int").alias("plain"),
        check.alias("check"),
        _edge(F.reverse(before)).alias("before"),
        _edge(after).alias("after"),
        before.rlike(_CUES[kind]).cast("int").alias("cue"),
        F.least(F.floor(F.log2(F.char_length(hit) + F.lit(1))), F.lit(7)).cast("int").alias("size"),
        meets.cast("int").alias("meets"),
    )


def _proposals(kind: str, text: Column, base: dict[str, Column]) -> Column:
    """array<struct<start, end, label, inside, x>>; label 1, 0 or null (unlabelled).

    inside: the span overlaps a base span of its own kind.
    """

    def meets(span: Column, kinds) -> Column:
        return reduce(lambda a, b: a | b, (F.exists(base[k], lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"])) for k in kinds))

    def one(span: Column) -> Column:
        same = F.exists(base[kind], lambda b: (b["start"] == span["start"]) & (b["end"] == span["end"]))
        own, other = meets(span, [kind]), meets(span, [k for k in KINDS if k != kind])
        x = _features(kind, text, span, other)
        in_word = x["before"].isin(2, 3) | x["after"].isin(2, 3)
        label = F.when(same, 1).when(~own & (other | in_word | (x["check"] == 0)), 0)
        if kind != "phone":  # whose check is too weak to be evidence
            label = label.when(~own & (x["cue"] == 1), 1)
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), label.alias("label"), own.alias("inside"), x.alias("x"))

    return F.transform(spans(text, WIDE[kind], NEEDS[kind]), one)


# ---------------------------------------------------------------- trees over counted features

TREES, RATE, LEAST = 24, 0.3, 4.0


def grow(rows: list[tuple[tuple[int, ...], float, float]]) -> list:
    """Boosted trees of depth two from (features, positives, negatives) cells.

    A tree is (feature, limit, left, right) or a leaf's value; left is feature <= limit.
    """
    scores = [0.0] * len(rows)
    trees = []

    def fit(idx: list[int], depth: int):
        g = {i: (rows[i][1] + rows[i][2]) / (1 + math.exp(-scores[i])) - rows[i][1] for i in idx}
        h = {i: max(1e-6, (rows[i][1] + rows[i][2]) * (p := 1 / (1 + math.exp(-scores[i]))) * (1 - p)) for i in idx}
        gs, hs = sum(g.values()), sum(h.values())
        best = (1e-6, None, None)
        if depth:
            for f in range(len(FEATURES)):
                cells: dict[int, list[float]] = {}
                for i in idx:
                    c = cells.setdefault(rows[i][0][f], [0.0, 0.0, 0.0])
                    c[0] += g[i]
                    c[1] += h[i]
                    c[2] += rows[i][1] + rows[i][2]
                gl = hl = nl = 0.0
                total = sum(c[2] for c in cells.values())
                for v in sorted(cells)[:-1]:
                    gl, hl, nl = gl + cells[v][0], hl + cells[v][1], nl + cells[v][2]
                    if min(nl, total - nl) < LEAST:
                        continue
                    gain = gl**2 / (hl + 1) + (gs - gl) ** 2 / (hs - hl + 1) - gs**2 / (hs + 1)
                    if gain > best[0] + 1e-9:
                        best = (gain, f, v)
        if best[1] is None:
            return -RATE * gs / (hs + 1)
        _, f, v = best
        return (f, v, fit([i for i in idx if rows[i][0][f] <= v], depth - 1), fit([i for i in idx if rows[i][0][f] > v], depth - 1))

    def value(tree, x: tuple[int, ...]) -> float:
        while isinstance(tree, tuple):
            tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
        return tree

    for _ in range(TREES):
        trees.append(fit(list(range(len(rows))), 2))
        scores = [s + value(trees[-1], r[0]) for s, r in zip(scores, rows)]
    return [trees, calibrate(list(zip(scores, rows)))]


def calibrate(scored: list) -> float:
    """The least score from which on labelled proposals reach the wanted precision, as probability at least a half."""
    best, good, bad = math.inf, 0.0, 0.0
    by = sorted(scored, key=lambda x: -x[0])
    for k, (s, (_, p, n)) in enumerate(by):
        good, bad = good + p, bad + n
        if k + 1 < len(by) and by[k + 1][0] == s:
            continue
        if good + bad and good / (good + bad) >= PRECISION:
            best = s
    return max(best, 0.0)


def score(trees: list, x: Column) -> Column:
    def one(tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        return F.when(x[FEATURES[tree[0]]] <= tree[1], one(tree[2])).otherwise(one(tree[3]))

    return reduce(lambda a, b: a + b, map(one, trees), F.lit(0.0))


def train(docs: DataFrame) -> dict[str, list]:
    """Per kind [trees, threshold], learned from all proposals of all texts."""
    text = docs.select(F.coalesce("text", F.lit("")).alias("text")).where(F.col("text").rlike("[0-9@＠]|[\\[({]at[\\])}]"))
    with_base = text.withColumns({f"b_{k}": v for k, v in base_spans(F.col("text")).items()})
    all_of = F.concat(*(F.filter(_proposals(k, F.col("text"), {b: F.col(f"b_{b}") for b in KINDS}), lambda c: c["label"].isNotNull()) for k in KINDS))
    cells = with_base.select(F.explode(all_of).alias("c")).select("c.label", *(f"c.x.{f}" for f in FEATURES))
    counted = cells.groupBy(*FEATURES).agg(
        F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")
    )  # at most one row for each combination of small integers
    rows = sorted((tuple(int(r[f]) for f in FEATURES), float(r["good"]), float(r["bad"])) for r in counted.collect())
    return {k: grow([r for r in rows if r[0][0] == i]) for i, k in enumerate(KINDS)}


# ---------------------------------------------------------------- the operator


def _selected(kind: str, proposals: Column, trees: list, threshold: float) -> Column:
    """array<struct<p, end, start, kind>> of the proposals that reach the threshold; p is the score."""
    scored = F.transform(
        F.filter(proposals, lambda c: ~c["inside"]),
        lambda c: F.struct(score(trees, c["x"]).alias("p"), c["end"].alias("end"), c["start"].alias("start"), F.lit(kind).alias("kind")),
    )
    return F.filter(scored, lambda c: c["p"] >= threshold)


def _best(found: Column) -> Column:
    """Of spans that overlap each other the one of the best score, then the longer one, then the first."""
    order = F.array_sort(F.transform(found, lambda c: F.struct((-c["p"]).alias("p"), (c["start"] - c["end"]).alias("size"), c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))))
    none = F.expr("cast(array() as array<struct<kind:string,start:int,end:int>>)")

    def step(kept: Column, c: Column) -> Column:
        span = F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"))
        clash = F.exists(kept, lambda k: (k["start"] < c["end"]) & (c["start"] < k["end"]))
        return F.when(clash, kept).otherwise(F.concat(kept, F.array(span)))

    return F.aggregate(order, none, step)


def scan(docs: DataFrame, model: dict[str, list], base_col: str = "base", added_col: str = "added") -> DataFrame:
    """``docs`` (all columns) with base and added spans: arrays of kind, start, end in code points."""
    docs = with_room(docs, base_col, added_col)
    held = dict(zip(KINDS, fresh(docs, *(f"of_{k}" for k in KINDS))))
    clean = F.coalesce(F.col("text"), F.lit(""))
    out = docs.withColumns({held[k]: v for k, v in base_spans(clean).items()})

    def named(kind: str) -> Column:
        return F.transform(F.col(held[kind]), lambda x: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    base = F.concat(*map(named, KINDS))
    none = F.expr("cast(array() as array<struct<p:double,end:int,start:int,kind:string>>)")
    added = []
    for k in KINDS:
        trees, threshold = model[k]
        if math.isfinite(threshold) and trees:
            added.append(_selected(k, _proposals(k, clean, {b: F.col(held[b]) for b in KINDS}), trees, threshold))
    return out.withColumns({base_col: base, added_col: _best(F.concat(none, *added))}).drop(*held.values())


def joined(found: Column) -> Column:
    """kind:start:end, comma-joined, in the order given."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def ordered(found: Column) -> Column:
    """By kind as listed, then start and end."""
    return F.concat(*(F.array_sort(of_kind(found, k)) for k in KINDS))


def redact(text: Column, found: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; spans that overlap are replaced as one, by the first's kind."""
    by_start = F.array_sort(F.transform(found, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        piece = F.concat(acc["out"], F.substring(text, acc["at"] + 1, x["start"] - acc["at"]), F.lit("["), F.upper(x["kind"]), F.lit("]"))
        one = F.struct(F.greatest(acc["at"], x["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(x["start"] >= acc["at"], F.struct(x["end"].alias("at"), piece.alias("out"))).otherwise(one)

    rest = F.aggregate(by_start, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text) - acc["at"])))
    return F.when(F.size(found) > 0, rest).otherwise(text)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))
    count = {f"n_{k}": F.size(of_kind(F.col("base"), k)).cast("long") for k in KINDS}
    return found.select(
        "doc_id",
        *(c.alias(n) for n, c in count.items()),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(ordered(F.concat("base", "added"))).alias("spans"),
    )


QUERIES = {"op9_pii": op9_pii}
