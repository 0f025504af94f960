"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Four kinds of seed entities are found by pattern (email, ip, card, phone).
Identifier-like tokens (with a digit or an @) and the words around them form
a bipartite graph of instances and lexical patterns.  Seeds, and the entries
of a high-entropy secret shape, start trusted; in each round a pattern's
confidence is the trusted share of its instances times the logarithm of
their number, and an instance's is the mean over its patterns.  Instances
that reach the bar join the trusted ones.  In the end, high-confidence
patterns mark identifier-like tokens that no seed covers as kind ``id``.

Places are code points.  Spark finds no match positions, so a text is split
at the matches: the pieces' and matches' lengths add up to the places, by
running sums in blocks, so the cost follows the text's length whatever it is.

Defined results: null text counts as empty; without spans base_sha256 is
that of the empty string and spans is empty; repeated rows get equal
results (each counts as an occurrence); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm.tables import keep, let, running, text_or_empty

KINDS = ("email", "ip", "card", "phone")

#: The kinds' patterns.  Possessive groups and look-behinds change no match;
#: they keep the search linear and free of recursion on very long texts.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

#: Identifier-like: a run of non-space that holds a digit or an @.
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
SECRET = r"^\W*(?=[0-9a-zA-Z]*[0-9])(?=[0-9a-zA-Z]*[a-zA-Z])[0-9a-zA-Z]{24,}\W*$"

ROUNDS = 3
MIN_TRUST = 0.5  # confidence of an instance that joins the trusted ones
MIN_PATTERN = 0.6  # confidence of a pattern that marks new spans
MIN_SUPPORT = 5  # trusted instances behind such a pattern
FEW = 64  # base spans that each token of a text is held against


def _matches(pattern: str) -> Column:
    """array<struct<s, e, m>> of all matches, from the column ``text``."""
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    gaps = lambda z: F.transform(F.slice(z["p"], 1, F.size(z["m"])), F.length)

    def place(z):
        start = running(F.zip_with(z["g"], z["m"], lambda g, m: g + F.length(m)))
        zipped = F.arrays_zip(start.alias("at"), z["g"].alias("g"), z["m"].alias("m"))
        s = lambda x: (x["at"] + x["g"]).cast("int")
        return F.transform(zipped, lambda x: F.struct(s(x).alias("s"), (s(x) + F.length(x["m"])).cast("int").alias("e"), x["m"].alias("m")))

    both = F.struct(found.alias("m"), F.split("text", pattern, -1).alias("p"))
    return let(both, lambda z: let(F.struct(z["m"].alias("m"), gaps(z).alias("g")), place))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Check of up to 19 digits, from the right."""
    d = F.reverse(F.filter(F.split(digits, ""), lambda x: x != ""))
    total = F.aggregate(
        F.transform(d, lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(F.when(x.cast("int") > 4, x.cast("int") * 2 - 9).otherwise(x.cast("int") * 2))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return total % 10 == 0


def _holds(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
        return m.rlike(rf"^{part}\.{part}\.{part}\.{part}$")
    if kind == "card":
        n = F.length(_digits(m))
        return (n >= 14) & (n <= 19) & _luhn(_digits(m))
    if kind == "phone":
        n = F.length(_digits(m))
        return (n >= 10) & (n <= 15)
    return F.lit(True)


_SPANS = "array<struct<s:int,k:int,e:int>>"


def base_spans() -> list[Column]:
    """One array<struct<s, k, e>> column per kind; most texts skip the costly part."""
    quick = {"email": "@", "ip": ".", "card": "", "phone": "+"}
    out = []
    for k, kind in enumerate(KINDS):
        some = F.col("text").rlike(PATTERNS[kind])
        if quick[kind]:
            some = F.contains("text", F.lit(quick[kind])) & some
        out.append(F.when(some, _spans_of(kind, k)).otherwise(F.array().cast(_SPANS)))
    return out


def _spans_of(kind: str, k: int) -> Column:
    good = F.filter(_matches(PATTERNS[kind]), lambda x: _holds(kind, x["m"]))
    return F.transform(good, lambda x: F.struct(x["s"].alias("s"), F.lit(k).alias("k"), x["e"].alias("e")))


def tokens() -> Column:
    """Identifier-like tokens: array<struct<s, e, m, l, r>> with the words left
    and right of each (lower-cased; empty at the text's ends)."""
    edge = r"[\x20\x09-\x0D]+"
    word = lambda p, i: F.lower(F.element_at(F.split(p, edge), i))
    around = lambda p: F.struct(F.length(p).cast("int").alias("n"), word(F.rtrim(p), -1).alias("l"), word(F.ltrim(p), 1).alias("r"))
    kind = "array<struct<s:int,e:int,m:string,l:string,r:string>>"

    def place(z):
        n = F.size(z["m"])
        start = running(F.zip_with(F.slice(z["p"], 1, n), z["m"], lambda p, m: p["n"] + F.length(m)))
        zipped = F.arrays_zip(start.alias("at"), F.slice(z["p"], 1, n).alias("p"), F.slice(z["p"], 2, n).alias("q"), z["m"].alias("m"))
        s = lambda x: (x["at"] + x["p"]["n"]).cast("int")
        return F.transform(
            zipped,
            lambda x: F.struct(s(x).alias("s"), (s(x) + F.length(x["m"])).cast("int").alias("e"), x["m"].alias("m"), x["p"]["l"].alias("l"), x["q"]["r"].alias("r")),
        )

    pieces = F.transform(F.split("text", TOKEN, -1), around)
    both = F.struct(F.regexp_extract_all("text", F.lit(TOKEN), F.lit(0)).alias("m"), pieces.alias("p"))
    return F.when(F.col("text").rlike("[0-9@]"), let(both, place)).otherwise(F.array().cast(kind))


_TOKEN = ["row", "s", "e", "m", "l", "r"]


def beside_few(spans: DataFrame) -> DataFrame:
    """Tokens of ``spans(row, tokens, base)``, a row each, and whether a base
    span overlaps them: each token looks at all of its text's few spans."""
    each = spans.select("row", "base", F.explode("tokens").alias("t")).select("row", "base", "t.*")
    return each.select(*_TOKEN, F.exists("base", lambda b: (b["s"] < F.col("e")) & (F.col("s") < b["e"])).alias("covered"))


def among_many(spans: DataFrame) -> DataFrame:
    """The same for texts with many spans: along the text, the furthest end of
    the spans that start before a token's end tells whether one overlaps it."""
    each = spans.select("row", F.explode("tokens").alias("t")).select("row", "t.*", F.col("t.e").alias("pos"), F.lit(None).cast("int").alias("reach"))
    ends = spans.select("row", F.explode("base").alias("b")).select("row", F.col("b.s").alias("pos"), F.col("b.e").alias("reach"))
    along = Window.partitionBy("row").orderBy("pos", F.col("reach").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = each.unionByName(ends, allowMissingColumns=True).withColumn("far", F.max("reach").over(along))
    return both.where("reach IS NULL").select(*_TOKEN, F.coalesce(F.col("far") > F.col("s"), F.lit(False)).alias("covered"))


def learn(instances: DataFrame) -> DataFrame:
    """``instances(row, s, m, l, r, seed)`` -> (pattern, confidence, support)
    of the graph after ROUNDS rounds.  A common pattern's rows are summed
    before they are shuffled; an instance type is a token's text."""
    left = F.concat(F.lit("l:"), "l")
    right = F.concat(F.lit("r:"), "r")
    edges = instances.select("m", "seed", F.explode(F.array(left, right)).alias("pattern")).where("length(pattern) > 2")
    edges = keep(edges.groupBy("pattern", "m").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed")), "pii-edges")
    trusted = edges.groupBy("m").agg(F.max("seed").alias("trust")).select("m", F.col("trust").cast("double").alias("trust"))
    scored = None
    for _ in range(ROUNDS):
        scored = (
            edges.join(trusted, "m").groupBy("pattern")
            .agg(F.sum(F.col("n") * F.col("trust")).alias("hits"), F.sum("n").alias("all"), F.sum(F.when(F.col("trust") > 0, 1).otherwise(0)).alias("support"))
            .select("pattern", (F.col("hits") / F.col("all")).alias("share"), "support",
                    F.least(F.lit(1.0), F.col("hits") / F.col("all") * F.log2(F.col("support") + 1) / 3).alias("confidence"))
        )
        scored = keep(scored, "pii-patterns")
        grown = edges.join(scored, "pattern").groupBy("m").agg(
            F.max("seed").alias("seed"), (F.sum(F.col("n") * F.col("confidence")) / F.sum("n")).alias("mean")
        )
        trusted = keep(grown.select("m", F.when(F.col("seed") | (F.col("mean") >= MIN_TRUST), 1.0).otherwise(0.0).alias("trust")), "pii-trust")
    return scored.where((F.col("confidence") >= MIN_PATTERN) & (F.col("support") >= MIN_SUPPORT)).select("pattern", "confidence")


def _line(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, "id")])
    one = lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))
    return F.array_join(F.transform(F.sort_array(spans), one), ",")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_id."""
    rows = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), text_or_empty().alias("text"))
    seen = rows.select("doc_id", "row", *[c.alias(k) for k, c in zip(KINDS, base_spans(), strict=True)], tokens().alias("tokens"))
    seen = keep(seen, "pii-texts")
    base = F.concat(*KINDS)
    spans = seen.select("row", "tokens", base.alias("base"))
    each = beside_few(spans.where(F.size("base") <= FEW)).unionByName(among_many(spans.where(F.size("base") > FEW)))
    instances = keep(each.withColumn("seed", F.col("covered") | F.col("m").rlike(SECRET)), "pii-instances")
    patterns = learn(instances.select("m", "l", "r", "seed"))
    fresh = instances.where("NOT covered").select("row", "s", "e", F.explode(F.array(F.concat(F.lit("l:"), "l"), F.concat(F.lit("r:"), "r"))).alias("pattern"))
    found = fresh.join(patterns, "pattern", "left_semi").select("row", "s", "e").distinct()
    more = found.groupBy("row").agg(F.collect_list(F.struct("s", F.lit(len(KINDS)).alias("k"), "e")).alias("more"))
    out = seen.select("doc_id", "row", *KINDS).join(more, "row", "left")
    extra = F.coalesce("more", F.array().cast(_SPANS))
    return out.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_line(base).cast("binary"), 256).alias("base_sha256"), _line(F.concat(base, extra)).alias("spans"), F.size(extra).cast("long").alias("n_id"),
    )
