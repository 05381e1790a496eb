"""Personal data by candidate gradient boosting, in DataFrame functions only.

Two kinds of spans:

* base spans: ``email``, ``ip``, ``card``, ``phone`` by fixed patterns and checks;
* added spans: high-recall generators (``email_like``, ``number_like``) propose
  candidates that may overlap base spans; boosted trees over format and context
  features score them; candidates over a calibrated threshold that touch no base
  span are added.

The trees learn from all labelled candidates of the corpus.  A candidate is positive if
it is, as a whole, a valid base form or stands after a cue word, negative if it stands
after a word against it or has a base form and fails its check; forms that no base
pattern knows (national phone numbers) are labelled by such words only, all
others have no label.  The words are no features.  Features are small whole numbers, so the
training data is a table of counts per feature combination of proven size
(``MAX_CELLS`` rows at most); the trees become column expressions.

Positions come from the pieces between matches: a text is split at a pattern
and the lengths of pieces and matches are added up (in code points).  Possessive quantifiers
and start conditions keep every pattern linear in the text, also for long texts.

Defined results: null text is an empty text (no spans); null doc_ids, repeated rows and
extra columns are carried as they are; spans of one start are ordered by kind;
an empty table gives no rows; with no positive candidate nothing is added.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panora.llm.common import landed

KINDS = ["email", "ip", "card", "phone", "email_like", "number_like"]
LOCAL, DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"

# The fixed patterns, written so that Java matches them without recursion and
# never tries the inside of a run whose start has failed.
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "email_like": r"(?:\G|(?<![^\s@<>\x22',;()\[\]]))[^\s@<>\x22',;()\[\]]++@[^\s@<>\x22',;()\[\]]++",
    "number_like": r"(?<![0-9A-Za-z])\+?[0-9](?:[-.()/\x20]{0,2}+[0-9]){6,}+",
}
#: a text without this character has no match
NEEDS = {"email": "@", "email_like": "@", "phone": "+"}

OCTET = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
CONTEXT = 40
CUES = r"(?i)(mail|contact|tel|phone|fax|call|mobile|card|visa|account|iban|passport|ssn|address|\bip\b)"
AGAINST = r"(?i)(version|isbn|order|\bno\.|invoice|ref|price|[$€£#]\s*$)"

FEATURES = {"kind": 2, "digits": 8, "groups": 5, "plus": 2, "dots": 4, "marks": 4, "joined": 2}
MAX_CELLS = math.prod(FEATURES.values())
TREES, RATE, PRECISION, SMOOTH = 24, 0.3, 0.99, 1.0


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"\A{OCTET}(?:\.{OCTET}){{3}}\z")
    if kind == "card":
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _barrier(df: DataFrame, **cols: Column) -> DataFrame:
    """Add columns through a one-row generator, so that the optimizer never
    copies their expressions into the lambdas that read them."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(k) for k, c in cols.items()]))))


BLOCK = 64


def _placed(kind: str):
    """A match and its number -> its span, from the lengths before it."""
    g, n, b, c = (F.col(f"__{x}_{kind}") for x in "gnbc")

    def total(x: Column) -> Column:
        return F.aggregate(x, F.lit(0), lambda a, y: a + y)

    def span(x, i):
        at = 2 * i + 1
        block = F.floor(at / BLOCK).cast("int")
        upper = F.floor(block / BLOCK).cast("int")
        start = (total(F.slice(c, F.lit(1), upper)) + total(F.slice(b, upper * BLOCK + 1, block - upper * BLOCK))
                 + total(F.slice(n, block * BLOCK + 1, at - block * BLOCK)))
        return F.struct(start.alias("start"), (start + F.length(x)).alias("end"), x.alias("match"),
                        F.substring(F.get(g, i), -CONTEXT, CONTEXT).alias("before"),
                        F.substring(F.get(g, i + 1), 1, 1).alias("after"))
    return span


def _checked(kind: str):
    return lambda c: F.coalesce(_valid(kind, c["match"]), F.lit(False))


def _bare(number: int):
    return lambda c: F.struct(c["start"].alias("start"), F.lit(number).alias("kind"), c["end"].alias("end"))


def _spans(df: DataFrame, text: Column, kinds: list[str]) -> DataFrame:
    """Columns ``__pii_<kind>``: array of (start, end, match, before, after) of
    all matches, leftmost first, not overlapping."""
    none = F.array().cast("array<string>")
    found, sizes = {}, {}
    has_digit = text.rlike("[0-9]")
    for k in kinds:
        near = F.instr(text, NEEDS[k]) > 0 if k in NEEDS else has_digit
        found[f"__m_{k}"] = F.when(near, F.regexp_extract_all(text, F.lit(PATTERNS[k]), F.lit(0))).otherwise(none)
        found[f"__g_{k}"] = F.when(near, F.split(text, PATTERNS[k], -1)).otherwise(none)
    df = _barrier(df, **found)
    for k in kinds:
        m, g = F.col(f"__m_{k}"), F.col(f"__g_{k}")
        # gap, match, gap, match, ... lengths
        sizes[f"__n_{k}"] = F.when(F.size(m) == 0, F.array().cast("array<int>")).otherwise(F.flatten(
            F.transform(F.arrays_zip(g.alias("g"), m.alias("m")),
                        lambda z: F.array(F.length(z["g"]), F.coalesce(F.length(z["m"]), F.lit(0))))))
    df = _barrier(df, **sizes)

    def blocks(n: Column) -> Column:
        """Sums of BLOCK elements each."""
        return F.when(F.size(n) == 0, F.array().cast("array<int>")).otherwise(
            F.transform(F.sequence(F.lit(0), F.floor(F.size(n) / BLOCK).cast("int")),
                        lambda b: F.aggregate(F.slice(n, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), lambda a, x: a + x)))
    df = _barrier(df, **{f"__b_{k}": blocks(F.col(f"__n_{k}")) for k in kinds})
    df = _barrier(df, **{f"__c_{k}": blocks(F.col(f"__b_{k}")) for k in kinds})
    df = _barrier(df, **{f"__pii_{k}": F.transform(F.col(f"__m_{k}"), _placed(k)) for k in kinds})
    return df.drop(*[f"__{x}_{k}" for x in "mgnbc" for k in kinds])


STRIDE = 512


def _running(df: DataFrame, name: str, values: Column, best, pair, least: int, backward: bool = False) -> DataFrame:
    """Column ``name``: the running maximum (or minimum) of an int array, itself included, from the
    front (or the back): strides first, so that no element looks at all others."""
    df = _barrier(df, **{f"{name}_v": values})
    v = F.col(f"{name}_v")
    strides = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / STRIDE).cast("int"))
    df = _barrier(df, **{f"{name}_s": F.when(F.size(v) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(strides, lambda b: best(F.slice(v, b * STRIDE + 1, F.lit(STRIDE)))))})
    s = F.col(f"{name}_s")

    def at(x: Column, i: Column) -> Column:
        b = F.floor(i / STRIDE).cast("int")
        if backward:
            inside, outside = F.slice(v, i + 1, (b + 1) * STRIDE - i), F.slice(s, b + 2, F.size(s))
        else:
            inside, outside = F.slice(v, b * STRIDE + 1, i - b * STRIDE + 1), F.slice(s, F.lit(1), b)
        return pair(best(inside), F.coalesce(best(outside), F.lit(least)))
    return _barrier(df, **{name: F.transform(v, at)}).drop(f"{name}_v", f"{name}_s")


def _bucket(v: Column, borders: list[int]) -> Column:
    out = F.lit(0)
    for b in borders:
        out = out + (v >= b).cast("int")
    return out


def _described(kind: str):
    """A candidate -> (start, kind, end, label, f: features in order)."""
    return lambda c: _features(kind, c, c["match"])


def _features(kind: str, c: Column, m: Column) -> Column:
    count = lambda p: F.length(m) - F.length(F.regexp_replace(m, p, ""))
    if kind == "email_like":
        valid = m.rlike(rf"\A{LOCAL}++@{DOMAIN}++(?:\.{DOMAIN}++)++\z")
        known = m.rlike(r"\A[A-Za-z0-9._%+@-]++\z")
        digits = _bucket(F.length(m), [6, 10, 16, 24, 36, 64])
        groups = _bucket(count(r"[^\x21-\x7e]"), [1, 2])
        marks = F.when(m.rlike(r"@.*\.[A-Za-z]{2,}\z"), 3).when(m.rlike(r"@.*\."), 2).otherwise(0)
    else:
        ip = m.rlike(r"\A[0-9]++(?:\.[0-9]++){3}\z")
        card = m.rlike(r"\A[0-9](?:[\x20-]?[0-9])++\z") & F.length(F.regexp_replace(m, "[^0-9]", "")).between(12, 19)
        phone = m.rlike(r"\A\+[0-9][\x20().0-9-]+[0-9]\z")
        valid = (ip & _valid("ip", m)) | (card & _valid("card", m)) | (phone & _valid("phone", m))
        known = ip | card | phone
        digits = _bucket(count("[0-9]"), [9, 10, 12, 13, 16, 17, 20])
        groups = _bucket(F.length(F.regexp_replace(F.regexp_replace(m, "[0-9]++", "d"), "[^d]", "")), [2, 3, 4, 5])
        marks = F.when(m.contains("("), 3).when(m.contains("-"), 2).when(m.contains(" "), 1).otherwise(0)
    joined = c["before"].rlike(r"[\w]\z") | c["after"].rlike(r"\A[\w]")
    label = F.when(valid, True).when(c["before"].rlike(AGAINST), False).when(c["before"].rlike(CUES), True) \
        .when(known, False)
    f = [F.lit(KINDS.index(kind) - 4), digits, groups, F.startswith(m, F.lit("+")).cast("int"),
         _bucket(count(r"\."), [1, 3, 4]), marks, joined.cast("int")]
    return F.struct(c["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), c["end"].alias("end"),
                    label.alias("label"),
                    F.array(*[x.cast("int") for x in f]).alias("f"))


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` plus ``__pii_base``: sorted (start, kind, end), kind by its place
    in KINDS, and ``__pii_more``: the described candidates of the generators."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = _spans(docs, text, KINDS)
    base = F.concat(*[F.transform(F.filter(F.col(f"__pii_{k}"), _checked(k)), _bare(i))
                      for i, k in enumerate(KINDS[:4])])
    more = F.concat(*[F.transform(F.col(f"__pii_{k}"), _described(k)) for k in KINDS[4:]])
    return _barrier(df, __pii_base=F.array_sort(base), __pii_more=more).drop(*[f"__pii_{k}" for k in KINDS])


# boosted trees over cells ----------------------------------------------------------
@dataclass
class Model:
    base: float = 0.0
    #: per tree: feature, border, then per side either (feature, border, low, high) or a value
    trees: list = field(default_factory=list)
    thresholds: dict = field(default_factory=dict)   # generator -> least score; absent: nothing is added

    def score(self, f: Column) -> Column:
        """Sum of the trees for a column of features."""
        total = F.lit(float(self.base))
        for feature, border, *sides in self.trees:
            values = [F.when(F.get(f, F.lit(s[0])) < s[1], float(s[2])).otherwise(float(s[3]))
                      if isinstance(s, tuple) else F.lit(float(s)) for s in sides]
            total = total + F.when(F.get(f, F.lit(feature)) < border, values[0]).otherwise(values[1])
        return total

    def plain(self, f) -> float:
        """The same score for one tuple of features."""
        total = self.base
        for feature, border, *sides in self.trees:
            s = sides[f[feature] >= border]
            total += s[2 + (f[s[0]] >= s[1])] if isinstance(s, tuple) else s
        return total


def _stump(cells, rows):
    """Best split of the given cells: (gain, feature, border, low value, high value)."""
    def leaf(part):
        g = sum(cells[r][1] for r in part)
        h = sum(cells[r][2] for r in part)
        return g, h, g * g / (h + SMOOTH)
    g0, h0, whole = leaf(rows)
    best = (0.0, None, None, -g0 / (h0 + SMOOTH), 0.0)
    for k, levels in enumerate(FEATURES.values()):
        for border in range(1, levels):
            low = [r for r in rows if cells[r][0][k] < border]
            if not low or len(low) == len(rows):
                continue
            g, h, a = leaf(low)
            b = (g0 - g) ** 2 / (h0 - h + SMOOTH)
            if a + b - whole > best[0] + 1e-9:
                best = (a + b - whole, k, border, -g / (h + SMOOTH), -(g0 - g) / (h0 - h + SMOOTH))
    return best


def train(counts: list[tuple]) -> Model:
    """Gradient boosting on (features, positives, negatives) cells, then one
    threshold per generator: the least score of which, and from which on, at least
    PRECISION of the labelled candidates are positive, however many there are."""
    counts = sorted(counts)
    pos, neg = sum(c[1] for c in counts), sum(c[2] for c in counts)
    if not pos:
        return Model()
    model = Model(base=math.log((pos + 1) / (neg + 1)))
    z = [model.base] * len(counts)
    for _ in range(TREES):
        cells = []
        for (f, p, n), s in zip(counts, z):
            q = 1 / (1 + math.exp(-s))
            cells.append((f, (p + n) * q - p, (p + n) * q * (1 - q)))
        gain, feature, border, low, high = _stump(cells, range(len(cells)))
        if feature is None:
            break
        sides = []
        for side, value in ((0, low), (1, high)):
            rows = [r for r, c in enumerate(cells) if (c[0][feature] >= border) == bool(side)]
            _, k, b, x, y = _stump(cells, rows)
            sides.append(RATE * value if k is None else (k, b, RATE * x, RATE * y))
        tree = (feature, border, *sides)
        model.trees.append(tree)
        one = Model(0.0, [tree])
        z = [s + one.plain(c[0]) for s, c in zip(z, counts)]
    for kind in (0, 1):
        own: dict = {}      # score -> positives, negatives
        for f, p, n in counts:
            if f[0] == kind and p + n:
                at = round(model.plain(f), 9)
                own[at] = own.get(at, (0, 0))[0] + p, own.get(at, (0, 0))[1] + n
        p_sum = n_sum = 0
        for s, (p, n) in sorted(own.items(), reverse=True):
            p_sum, n_sum = p_sum + p, n_sum + n
            if p >= PRECISION * (p + n) and p_sum >= PRECISION * (p_sum + n_sum):
                model.thresholds[kind + 4] = s - 1e-8
    return model


def fit(found: DataFrame) -> Model:
    """Learn from the candidates of all documents: counts per feature
    combination, MAX_CELLS rows at most, come to the driver."""
    cells = found.select(F.explode("__pii_more").alias("c")).groupBy("c.f") \
        .agg(F.count_if("c.label").alias("p"), F.count_if(~F.col("c.label")).alias("n")).collect()
    return train([(tuple(r.f), r.p, r.n) for r in cells])


def detect(found: DataFrame, model: Model) -> DataFrame:
    """``found`` with ``__pii_spans``: base spans and added ones, sorted."""
    base = F.col("__pii_base")
    spans = base
    if model.thresholds:
        bar = F.create_map(*[F.lit(x) for kv in model.thresholds.items() for x in kv])
        good = F.filter("__pii_more", lambda c: model.score(c["f"]) >= F.coalesce(
            bar[c["kind"]], F.lit(float("inf"))))
        # one sorted row of base and added spans: an added one stays if no base span before it reaches beyond its start
        # and none after it starts before its end
        entry = "array<struct<start:int,added:int,kind:int,end:int>>"
        union = F.array_sort(F.concat(
            F.transform(base, lambda b: F.struct(b["start"].alias("start"), F.lit(0).alias("added"),
                                                 b["kind"].alias("kind"), b["end"].alias("end"))).cast(entry),
            F.transform(good, lambda c: F.struct(c["start"].alias("start"), F.lit(1).alias("added"),
                                                 c["kind"].alias("kind"), c["end"].alias("end"))).cast(entry)))
        found = _barrier(found, __pii_all=union)
        every = F.col("__pii_all")
        far = 2 ** 31 - 1
        found = _running(found, "__pii_reach", F.transform(every, lambda x: F.when(x["added"] == 0, x["end"]).otherwise(-1)),
                         F.array_max, F.greatest, -1)
        found = _running(found, "__pii_next", F.transform(every, lambda x: F.when(x["added"] == 0, x["start"]).otherwise(far)),
                         F.array_min, F.least, far, backward=True)
        kept = F.filter(every, lambda x, i: (x["added"] == 0) | ((F.get("__pii_reach", i) <= x["start"])
                                                                & (F.get("__pii_next", i) >= x["end"])))
        spans = F.array_sort(F.transform(kept, lambda c: F.struct(
            c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"))))
        return _barrier(found, __pii_spans=spans).drop("__pii_all", "__pii_reach", "__pii_next")
    return _barrier(found, __pii_spans=spans)


def shown(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count(spans: Column, kind: str) -> Column:
    """Spans of one kind."""
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


PART = 256


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``docs`` with every span of its text replaced by ``[KIND]`` (overlapping
    spans by the first one's); ``n_chars`` follows if there is one."""
    columns = docs.columns
    # candidates are looked for once: the fit reads their features, the rest their spans
    found = landed(candidates(docs), "pii-candidates")
    df = detect(found, model or fit(found))
    # overlapping spans become one: a span that starts behind all earlier ends opens one
    df = _running(df, "__pii_ends", F.transform("__pii_spans", lambda s: s["end"]), F.array_max, F.greatest, -1)
    places = F.when(F.size("__pii_spans") > 0, F.sequence(F.lit(0), F.size("__pii_spans") - 1)).otherwise(
        F.array().cast("array<int>"))
    df = _barrier(df, __pii_first=F.filter(places, lambda i: (i == 0) | (
        F.get("__pii_spans", i)["start"] >= F.get("__pii_ends", i - 1))))
    df = _barrier(df, __pii_spans1=F.transform("__pii_first", lambda i, k: F.struct(
        F.get("__pii_spans", i)["start"].alias("start"), F.get("__pii_spans", i)["kind"].alias("kind"),
        F.coalesce(F.get("__pii_ends", F.get("__pii_first", k + 1) - 1),
                   F.get("__pii_ends", F.size("__pii_ends") - 1)).alias("end"))),
                  __pii_parts=F.when(F.size("__pii_spans") > 0, F.regexp_extract_all(
                      F.col("text").cast("string"), F.lit(f"(?s).{{1,{PART}}}"), F.lit(0)))
                  .otherwise(F.array().cast("array<string>")))
    spans, parts = F.col("__pii_spans1"), F.col("__pii_parts")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def between(a: Column, b: Column) -> Column:
        """Code points a to b of the text, from parts of PART."""
        first, last = F.floor(a / PART).cast("int"), F.floor((b - 1) / PART).cast("int")
        return F.when(b <= a, "").otherwise(F.array_join(F.transform(
            F.sequence(first, F.greatest(first, last)),
            lambda j: F.substring(F.get(parts, j), F.greatest(F.lit(0), a - j * PART) + 1,
                                  F.least(F.lit(PART), b - j * PART) - F.greatest(F.lit(0), a - j * PART))), ""))

    def piece(s, i):
        before = F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(F.lit(0))
        return F.concat(between(before, s["start"]), F.get(names, s["kind"]))
    tail = between(F.element_at(spans, -1)["end"], F.length(F.col("text").cast("string")))
    text = F.when(F.size(spans) > 0, F.concat(F.array_join(F.transform(spans, piece), ""), tail)) \
        .otherwise(F.col("text"))
    df = _barrier(df, __pii_text=text)
    new = {"text": F.col("__pii_text")}
    if "n_chars" in columns:
        kind = dict(docs.dtypes)["n_chars"]
        new["n_chars"] = F.when(F.size("__pii_spans") > 0, F.length("__pii_text").cast(kind)) \
            .otherwise(F.col("n_chars"))
    return df.select(*[new[c].alias(c) if c in new else F.col(f"`{c}`") for c in columns])
