"""Personal data by candidate gradient boosting, in DataFrame functions only (operator 5).

Base spans come from four fixed patterns with validity rules and always stay.
Beyond them, wider generators propose overlapping spans with a high recall:
spelt-out addresses, bracketed dots, other separators, numbers without a plus
sign.  Boosted trees judge a proposal by format and context (digits, separators,
check digit, largest part, neighbouring characters, a keyword before it); those
at or above a calibrated threshold, and clear of base spans, become spans too.

The trees are trained on the driver in plain numpy, on a bounded sample of
candidates, and applied as a column expression.  Right are valid base spans, the
same spans in a disguise that the base patterns don't know (:func:`disguised`) and,
among proposals clear of base spans, those with evidence that the base patterns
do not look at (:func:`evidence`, on the match without its disguise); all other
clear proposals, numeric noise above all, are wrong.  The threshold of each kind
is the lowest score at which at least ``PRECISION`` of the disguised and clear cases
in the held-out fifth of the sample are right, at any number of them; a kind without
such cases takes the score of that probability.  If the sample has no right or no
wrong case, nothing can be learnt and no spans are added.

Positions are code points, the end exclusive.  The counts n_* are those of base
spans; ``n_spans`` counts all and
``n_added`` the others.  Null text counts as empty.  A row's result
depends on its text and the trees alone, so repeated rows are equal.  Other columns
are carried through.  No shuffle,
no Python on the executors.  An empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import free_names, table

KINDS = ("email", "ip", "card", "phone")
#: Rows drawn for training at most, documents they are drawn from, and least share of right ones among accepted.
SAMPLE_CANDIDATES = 12_000
SAMPLE_DOCS = 20_000
PRECISION = 0.99
CONTEXT = 24
#: Items that a scan over matches gathers at a time, and the type of a span.
SCAN = 256
SPAN = "struct<s:int,k:int,e:int,m:string,b:string,a:string>"

# The base patterns, with possessive repeats and look-behinds that give the same matches in linear time.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@| ?\[at\] ?| ?\(at\) ?)[A-Za-z0-9-]++(?:(?:\.| ?\[dot\] ?| ?\(dot\) ?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]{1,4}+(?:(?:\.|\[\.\])[0-9]{1,4}+){3}",
    "card": r"(?<![0-9])[0-9](?:[ ./-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9])(?:\+|00)?[0-9(][ ().0-9/-]{7,20}[0-9]",
}
KEYWORDS = {
    "email": r"(?i)(mail|contact|write)[^a-z]*$",
    "ip": r"(?i)(\bip|host|address|server)[^a-z]*$",
    "card": r"(?i)(card|visa|credit|payment)[^a-z]*$",
    "phone": r"(?i)(tel|phone|call|mobile|fax)[^a-z]*$",
}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
FEATURES = ("kind", "digits", "others", "letters", "plus", "luhn", "octets", "glued_before", "glued_after", "keyword", "obfuscated", "groups", "issuer", "quartets", "domain", "abroad")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check."""

    def total(back: Column) -> Column:
        def add(sum_: Column, i: Column) -> Column:
            d = F.ascii(F.substring(back, i, F.lit(1))) - 48
            return sum_ + F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(back))), F.lit(0), add)

    return _once(F.reverse(digits), total) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    n = F.length(_digits(match))
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return n.between(14, 19) & luhn(_digits(match))
    if kind == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _validity(kind: str) -> Callable[[Column], Column]:
    return lambda x: valid(kind, x["m"])


def _of_kind(k: int) -> Callable[[Column], Column]:
    return lambda x: x["k"] == k


def _once(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once; in a lambda a column would be computed at each step."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _scan(count: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """The items of step(pos, i) for i from 1 to count; a step gives a struct of the next pos and the item.

    Items are gathered in blocks, as appending to one array would copy all items each time.
    """
    span = lambda low, high: F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))
    empty = lambda t: F.expr(f"cast(array() as array<{t}>)")

    def inner(pos: Column, block: Column) -> Column:
        start = F.struct(pos.alias("pos"), empty(kind).alias("out"))
        one = lambda acc, i: _once(step(acc["pos"], i), lambda r: F.struct(r["pos"].alias("pos"), F.array_append(acc["out"], r["item"]).alias("out")))
        return F.aggregate(span(block * SCAN + 1, F.least((block + 1) * SCAN, count)), start, one)

    start = F.struct(F.lit(0).alias("pos"), empty(f"array<{kind}>").alias("out"))
    more = lambda acc, block: _once(inner(acc["pos"], block), lambda r: F.struct(r["pos"].alias("pos"), F.array_append(acc["out"], r["out"]).alias("out")))
    blocks = F.ceil(count / SCAN).cast("int")
    return F.flatten(F.aggregate(span(F.lit(0), blocks - 1), start, more)["out"])


def found(text: Column, kind: str, pattern: str) -> Column:
    """All matches with positions and context: an array of (s, k, e, m, b, a).

    The text's pieces between matches and the matches themselves alternate, so positions are running sums.
    """
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("p"))

    def spans(v: Column) -> Column:
        def step(pos: Column, i: Column) -> Column:
            m, before, after = F.element_at(v["m"], i), F.element_at(v["p"], i), F.element_at(v["p"], i + 1)
            s = pos + F.length(before)
            span = F.struct(s.alias("s"), F.lit(KINDS.index(kind)).alias("k"), (s + F.length(m)).alias("e"), m.alias("m"), F.right(before, F.lit(CONTEXT)).alias("b"), F.left(after, F.lit(2)).alias("a"))
            return F.struct((s + F.length(m)).alias("pos"), span.alias("item"))

        return _scan(F.size(v["m"]), step, SPAN)

    return _once(both, spans)


_NONE = f"cast(array() as array<{SPAN}>)"


def base_spans(text: Column) -> Column:
    """Valid base spans of all kinds by start, then kind."""
    has = {"email": F.contains(text, F.lit("@")), "ip": F.contains(text, F.lit(".")) & text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike("[0-9][ -]?[0-9]"), "phone": F.contains(text, F.lit("+"))}
    parts = [F.when(has[k], F.filter(found(text, k, BASE[k]), _validity(k))).otherwise(F.expr(_NONE)) for k in KINDS]
    return F.array_sort(F.concat(*parts))


def proposals(text: Column, kinds: tuple[str, ...] | list[str] = KINDS) -> Column:
    """Spans of the wide generators; they may overlap each other and base spans."""
    digits = text.rlike("[0-9]")
    has = {"email": F.contains(text, F.lit("@")) | text.rlike(r"[\[(]at[\])]"), "ip": digits, "card": digits, "phone": digits}
    return F.concat(*[F.when(has[k], found(text, k, WIDE[k])).otherwise(F.expr(_NONE)) for k in kinds])


def overlaps(base: Column, x: Column) -> Column:
    return F.exists(base, lambda b: (b["s"] < x["e"]) & (x["s"] < b["e"]))


def plain(match: Column) -> Column:
    """A match without spelt-out and bracketed signs."""
    return F.regexp_replace(F.regexp_replace(match, r" ?[\[(]at[\])] ?", "@"), r" ?[\[(]dot[\])] ?|\[\.\]", ".")


def _values(x: Column) -> dict[str, Column]:
    m, digits = x["m"], _digits(x["m"])
    keyword = F.lit(False)
    for k, name in enumerate(KINDS):
        keyword = F.when(x["k"] == k, x["b"].rlike(KEYWORDS[name])).otherwise(keyword)
    return {
        "kind": x["k"],
        "digits": F.length(digits),
        "others": F.length(m) - F.length(digits),
        "letters": F.length(F.regexp_replace(m, "[^A-Za-z]", "")),
        "plus": m.startswith("+"),
        "luhn": (F.length(digits) > 0) & luhn(digits),
        "octets": m.rlike(rf"^{OCTET}(?:(?:\.|\[\.\]){OCTET}){{3}}$"),
        "glued_before": x["b"].rlike(r"[A-Za-z0-9.+-]$"),
        "glued_after": x["a"].rlike(r"^(?:[A-Za-z0-9]|[.-][0-9])"),
        "keyword": keyword,
        "obfuscated": m.rlike(r"[\[(]"),
        "groups": F.length(F.regexp_replace(m, "[A-Za-z0-9]", "")),
        "issuer": digits.rlike("^[2-6]"),
        "quartets": m.rlike(r"^[0-9]{4}([ ./-])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}$"),
        "domain": plain(m).rlike(r"^[^@]*[A-Za-z][^@]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}$"),
        "abroad": m.rlike(r"^(?:\+|00)[1-9][0-9]{0,2}[ ()./-]"),
    }


def evidence(x: Column) -> Column:
    """Whether a proposal's undisguised form, neighbours and keyword speak for its kind."""
    v = _values(x)
    loose = ~v["glued_before"] & ~v["glued_after"]
    rules = {
        "email": v["domain"] & loose,
        "ip": v["octets"] & loose,
        "card": v["digits"].between(13, 19) & v["luhn"] & v["issuer"] & loose & (v["keyword"] | v["quartets"]),
        "phone": v["digits"].between(10, 15) & loose & (v["keyword"] | v["abroad"]),
    }
    told = F.lit(False)
    for k, name in enumerate(KINDS):
        told = F.when(x["k"] == k, rules[name]).otherwise(told)
    return told


def feature(x: Column) -> Column:
    """The features of a span, as doubles, in the order of FEATURES."""
    values = _values(x)
    return F.array(*[values[name].cast("double") for name in FEATURES])


@dataclass(frozen=True)
class Trees:
    """Boosted trees of depth two: (feature, cut, (feature, cut, low, high) on either side), and thresholds by kind."""

    base: float
    trees: tuple
    thresholds: tuple[float, ...]

    def score(self, f: Column) -> Column:
        """Log-odds of a feature array."""
        total = F.lit(self.base)
        for i, cut, low, high in self.trees:
            sides = [F.when(f[j] <= c, F.lit(a)).otherwise(F.lit(b)) for j, c, a, b in (low, high)]
            total = total + F.when(f[i] <= cut, sides[0]).otherwise(sides[1])
        return total

    def score_rows(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for i, cut, low, high in self.trees:
            sides = [np.where(x[:, j] <= c, a, b) for j, c, a, b in (low, high)]
            total += np.where(x[:, i] <= cut, *sides)
        return total

    def kinds(self) -> list[str]:
        """The kinds that have a threshold."""
        return [k for k, t in zip(KINDS, self.thresholds, strict=True) if t < float("inf")]

    def accepts(self, k: Column, f: Column) -> Column:
        limit = F.element_at(F.array(*[F.lit(t) for t in self.thresholds]), k + 1)
        return self.score(f) >= limit


NO_TREES = Trees(0.0, (), (float("inf"),) * len(KINDS))


def _best_cut(x: np.ndarray, slope: np.ndarray, weight: np.ndarray, rows: np.ndarray) -> tuple[float, int, float]:
    """Gain, feature and cut of the best split of some rows."""
    best = (0.0, 0, 0.0)
    total, mass = slope[rows].sum(), weight[rows].sum()
    for j in range(x.shape[1]):
        for cut in np.unique(x[rows, j])[:-1][:64]:
            low = rows[x[rows, j] <= cut]
            g, h = slope[low].sum(), weight[low].sum()
            gain = g * g / (h + 1) + (total - g) ** 2 / (mass - h + 1) - total * total / (mass + 1)
            if gain > best[0] + 1e-9:
                best = (float(gain), j, float(cut))
    return best


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 16, rate: float = 0.4) -> Trees:
    """Gradient boosting of the log loss with second-order leaf values."""
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    score, trees = np.full(len(y), base), []

    def leaf(rows: np.ndarray) -> float:
        return float(rate * slope[rows].sum() / (weight[rows].sum() + 1))

    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        slope, weight = y - p, p * (1 - p)
        every = np.arange(len(y))
        gain, i, cut = _best_cut(x, slope, weight, every)
        if gain <= 1e-6:
            break
        sides = []
        for rows in (every[x[:, i] <= cut], every[x[:, i] > cut]):
            _, j, c = _best_cut(x, slope, weight, rows)
            sides.append((j, c, leaf(rows[x[rows, j] <= c]), leaf(rows[x[rows, j] > c])))
        trees.append((i, cut, *sides))
        score = Trees(base, tuple(trees), ()).score_rows(x)
    return Trees(base, tuple(trees), (float("inf"),) * len(KINDS))


def disguised(x: Column) -> Column:
    """A base span written as the base patterns don't know it, with its neighbours."""
    m = x["m"]
    forms = {
        "email": F.regexp_replace(F.regexp_replace(m, "@", " [at] "), r"\.(?=[A-Za-z0-9-]+$)", " [dot] "),
        "ip": F.regexp_replace(m, r"\.", "[.]"),
        "card": F.regexp_replace(_digits(m), "([0-9]{4})(?=[0-9])", "$1/"),
        "phone": F.regexp_replace(F.substring(m, F.lit(2), F.length(m)), "[()]", ""),
    }
    told = m
    for k, name in enumerate(KINDS):
        told = F.when(x["k"] == k, forms[name]).otherwise(told)
    return F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), told.alias("m"), x["b"].alias("b"), x["a"].alias("a"))


def fit(docs: DataFrame) -> Trees:
    """Train on a bounded sample; deterministic for equal tables."""
    share = min(1.0, SAMPLE_DOCS / max(1, docs.count()))
    chosen = docs.where(F.col("text").isNotNull() & (F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) < int(share * (1 << 20))))
    text = F.col("text")
    same = lambda base, x: F.exists(base, lambda b: (b["k"] == x["k"]) & (b["s"] == x["s"]) & (b["e"] == x["e"]))

    def judged(v: Column) -> Column:
        each = F.transform(v["x"], lambda x: F.struct(x.alias("x"), same(v["base"], x).alias("same")))
        return F.filter(each, lambda c: c["same"] | ~overlaps(v["base"], c["x"]))

    cases_ = _once(F.struct(base_spans(text).alias("base"), proposals(text).alias("x")), judged)
    told = chosen.where(text.rlike("[0-9@]|[\\[(]at[\\])]")).select("doc_id", F.explode(cases_).alias("c")).select("doc_id", "c.x", "c.same")
    # a base span counts as it is, and once more in disguise, which stands for what the base patterns miss
    cases = F.array(F.struct(F.col("x").alias("x"), ~F.col("same")), F.struct(disguised(F.col("x")).alias("x"), F.lit(True)))
    each = told.select("doc_id", "same", F.explode(F.when(F.col("same"), cases).otherwise(F.slice(cases, 1, 1))).alias("c")).select("doc_id", "same", "c.x", F.col("c.col2").alias("clear"))
    right = F.col("same") | evidence(F.col("x"))
    rows = each.select(F.xxhash64("doc_id", "x.s", "x.k").alias("place"), feature(F.col("x")).alias("f"), right.cast("int").alias("y"), "clear").orderBy("place", "clear", "y", "f").limit(SAMPLE_CANDIDATES).collect()
    if not rows:
        return NO_TREES
    x, y = np.array([r["f"] for r in rows], float), np.array([r["y"] for r in rows], float)
    held, clear = np.array([r["place"] % 5 == 4 for r in rows], bool), np.array([r["clear"] for r in rows], bool)
    if len(set(y[~held])) < 2:
        return NO_TREES
    trees = boost(x[~held], y[~held])
    score, limits = trees.score_rows(x[held]), []
    for k in range(len(KINDS)):
        mine = (x[held][:, 0] == k) & clear[held]
        s, right = score[mine], y[held][mine]
        # without held-out cases of a kind the trees' own probability decides
        limit = float(np.log(PRECISION / (1 - PRECISION)))
        for cut in np.unique(s):
            if right[s >= cut].mean() >= PRECISION:
                limit = max(float(cut), 0.0)
                break
        limits.append(limit)
    return Trees(trees.base, trees.trees, tuple(limits))


def with_spans(docs: DataFrame, trees: Trees, text: str = "text", names: tuple[str, str] = ("base_spans", "spans")) -> DataFrame:
    """Add two arrays of (s, k, e): base spans, and all spans, by start and kind.

    A new column whose name an input column has, in any case, gets underscores in front.
    """
    first, second = free_names(docs.columns, list(names))
    t = F.coalesce(F.col(text), F.lit(""))
    short = lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"))
    docs = docs.withColumn(first, F.transform(base_spans(t), short))
    base = F.col(first)
    if not trees.kinds():
        return docs.withColumn(second, base)
    judged = lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e"), feature(x).alias("f"))
    accepted = F.filter(F.transform(proposals(t, trees.kinds()), judged), lambda x: trees.accepts(x["k"], x["f"]))

    def joined(v: Column) -> Column:
        added = F.transform(F.filter(v["more"], lambda x: ~overlaps(v["base"], x)), short)
        return F.array_sort(F.array_distinct(F.concat(v["base"], added)))

    return docs.withColumn(second, _once(F.struct(base.alias("base"), accepted.alias("more")), joined))


def shown(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))))


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one."""
    marks = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS], F.lit(""))

    def joined(v: Column) -> Column:
        def step(pos: Column, i: Column) -> Column:
            x = F.element_at(v["x"], i)
            fresh = x["s"] >= pos
            piece = F.struct(pos.alias("from"), F.when(fresh, x["s"] - pos).otherwise(0).alias("n"), F.when(fresh, x["k"]).otherwise(len(KINDS)).alias("k"))
            return F.struct(F.greatest(pos, x["e"]).alias("pos"), piece.alias("item"))

        # bytes of a fixed width a character can be cut anywhere at once
        cut = lambda start, n: F.decode(F.substring(v["wide"], start * 4 + 1, n * 4), "UTF-32")
        pieces = F.transform(_scan(F.size(v["x"]), step, "struct<from:int,n:int,k:int>"), lambda p: F.concat(cut(p["from"], p["n"]), F.element_at(marks, p["k"] + 1)))
        return F.concat(F.array_join(pieces, ""), cut(F.array_max(F.transform(v["x"], lambda x: x["e"])), F.length(v["wide"])))

    return F.when(F.size(spans) > 0, _once(F.struct(F.encode(text, "UTF-32").alias("wide"), spans.alias("x")), joined)).otherwise(text)


def redact(docs: DataFrame, trees: Trees, text: str = "text") -> DataFrame:
    """Replace all spans in the text; other columns stay, null text stays null."""
    out = with_spans(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).alias("t")), trees, "t", ("base", "every"))
    return out.select(*[(redacted(F.col("t"), F.col("every")) if c == text else F.col("row").getField(c)).alias(c) for c in docs.columns])


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spans = with_spans(docs, fit(docs))
    count = [F.size(F.filter("base_spans", _of_kind(k))).cast("long").alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return spans.select(
        "doc_id", *count, F.sha2(shown(F.col("base_spans")), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"), F.size("spans").cast("long").alias("n_spans"), (F.size("spans") - F.size("base_spans")).cast("long").alias("n_added")
    )
