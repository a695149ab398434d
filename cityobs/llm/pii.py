"""Personal data: patterns of four kinds, and identifiers found by bootstrapping from their contexts.

Base entities are the matches of one expression per kind that pass the kind's check. They seed a
bipartite graph: every entity and every other identifier-like match (a candidate) is an instance,
and its surroundings give it lexical patterns: the last word or two before it, its shape, and both.
A pattern's score for a kind is the mean score of its instances, less for few of them; an instance's
is the chance that any of its patterns is right. After some rounds the candidates that a
high-confidence pattern vouches for are reported as found.

Positions come from the lengths of the pieces between matches, summed in order, so any number of
matches in a text costs linear time. Expressions are written without backtracking into runs.
Defined cases: a null or empty text has no spans; rows are told apart by id and text, so repeated
rows get the same spans and null ids are an id like others; a candidate that overlaps a base span is
none; of kinds with equal scores the first in order is taken; an empty table gives an empty table;
other columns pass through by name, one named ``spans`` as ``spans_input``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityobs.llm.columns import unpacked, whole
from cityobs.scratch import materialise

#: Kinds in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone")
#: The kinds' expressions. Possessive repetition and the looks behind only avoid useless attempts:
#: inside a run of name characters or digits a match can only begin where the last one ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Words with a digit; those of six characters and three digits at least are candidates.
MIXED = r"(?<![A-Za-z0-9._@-])[A-Za-z0-9._@-]*[0-9][A-Za-z0-9._@-]*"
#: A text without this has no match of the kind.
NEEDS = {"email": "@", "phone": "+"}
#: Characters before a match that its patterns are taken from.
CONTEXT = 48
ROUNDS = 3
#: Score from which a pattern counts at all, and from which a candidate is reported.
PATTERN_SCORE, REPORT_SCORE = 0.5, 0.8
#: Distinct instances that a pattern is thought to have got wrong before any is seen.
CAUTION = 1.0


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the weighted digit sum of a string of digits ends in 0."""
    each = F.split(F.reverse(digits), "")

    def value(d: Column, i: Column) -> Column:
        n = F.coalesce(d.try_cast("int"), F.lit(0)) * (i % 2 + 1)
        return F.when(n > 9, n - 9).otherwise(n)

    return F.aggregate(F.transform(each, value), F.lit(0), lambda a, v: a + v) % 10 == 0


def valid(kind: Column, match: Column) -> Column:
    """The check that a match of the kind must pass."""
    digits = _digits(match)
    part = lambda p: F.concat(F.lit("0"), F.regexp_replace(p, "^0+", ""))
    ip = F.forall(F.split(match, r"\."), lambda p: (F.length(part(p)) <= 4) & (F.coalesce(part(p).try_cast("int"), F.lit(999)) <= 255))
    n = F.length(digits)
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", ip)
        .when(kind == "card", F.when(n.between(12, 19), luhn(digits)).otherwise(False))
        .when(kind == "phone", n.between(9, 15))
        .otherwise(False)
    )


def _matches(docs: DataFrame) -> DataFrame:
    """Every match of every expression with its place and what stands before it."""
    digit = F.col("t").rlike("[0-9]")
    by_kind = []
    for kind, pattern in [*PATTERNS.items(), ("mixed", MIXED)]:
        where = F.contains("t", F.lit(NEEDS[kind])) if kind in NEEDS else digit
        found = F.when(where, F.regexp_extract_all("t", F.lit(pattern), F.lit(0)))
        between = F.when(where, F.split("t", pattern, -1))
        zipped = F.zip_with(
            found,
            F.slice(between, F.lit(1), F.size(found)),
            lambda m, piece: F.struct(
                F.lit(kind).alias("kind"),  # noqa: B023
                F.length(piece).alias("gap"),
                F.right(piece, F.lit(CONTEXT)).alias("before"),
                m.alias("match"),
            ),
        )
        by_kind.append(F.coalesce(F.transform(zipped, lambda s, i: F.struct(i.alias("i"), s.alias("s"))), F.array().cast(ROWS)))
    rows = docs.select("id", "h", F.explode(F.concat(*by_kind)).alias("m")).select("id", "h", "m.i", "m.s.*")
    order = Window.partitionBy("id", "h", "kind").orderBy("i")
    run = F.sum(F.col("gap") + F.length("match")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return (
        rows.dropDuplicates(["id", "h", "kind", "i"])
        .withColumn("end", run)
        .withColumn("start", F.col("end") - F.length("match"))
        .select("id", "h", "kind", "start", "end", "before", "match")
    )


ROWS = "array<struct<i:int,s:struct<kind:string,gap:int,before:string,match:string>>>"


def _apart(found: DataFrame) -> DataFrame:
    """Base spans, and candidates that overlap none of them nor an earlier, longer candidate."""
    base = F.col("base")
    order = Window.partitionBy("id", "h").orderBy("start", F.col("end").desc(), F.col("base").desc(), "kind")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    marked = found.withColumns(
        {
            "__base_end": F.max(F.when(base, F.col("end"))).over(before),
            "__any_end": F.max("end").over(before),
            "__base_start": F.min(F.when(base, F.col("start"))).over(after),
        }
    )
    clear = (
        (F.coalesce("__base_end", F.lit(-1)) <= F.col("start"))
        & (F.coalesce("__any_end", F.lit(-1)) <= F.col("start"))
        & (F.coalesce("__base_start", F.col("end")) >= F.col("end"))
    )
    return marked.where(base | clear).drop("__base_end", "__any_end", "__base_start")


def _lexical(found: DataFrame) -> DataFrame:
    """One row per instance and pattern."""
    words = F.filter(F.split(F.lower("before"), r"[\s\"'=]+"), lambda w: w != "")
    last = F.coalesce(F.try_element_at(words, F.lit(-1)), F.lit(""))
    two = F.concat_ws(" ", F.coalesce(F.try_element_at(words, F.lit(-2)), F.lit("")), last)
    shape = F.regexp_replace(F.regexp_replace(F.substring("match", 1, 64), "[0-9]", "9"), "[A-Za-z]+", "a")
    patterns = F.array(
        F.concat(F.lit("1:"), last),
        F.concat(F.lit("2:"), two),
        F.concat(F.lit("s:"), shape),
        F.concat(F.lit("1s:"), last, F.lit("\t"), shape),
    )
    return found.select("match", F.explode(patterns).alias("pattern")).distinct()


def _few(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """Broadcast only if the written rows are few."""
    return F.broadcast(df) if df.count() <= rows else df


def bootstrap(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``match``, ``kind`` and ``score`` of the candidates that patterns vouch for.

    Instances are distinct strings and edges are distinct, so a string or context that a third of
    all rows repeat weighs as one; sums over a pattern's instances are combined before the shuffle.
    """
    edges = materialise(_lexical(found), "pii-edges")
    seeds = materialise(found.where("base").groupBy("match", "kind").agg(F.lit(1.0).alias("score")), "pii-seeds")
    sizes = materialise(edges.groupBy("pattern").agg(F.count("*").alias("n")), "pii-patterns")
    scores = seeds
    for k in range(rounds):
        sums = edges.join(scores, "match").groupBy("pattern", "kind").agg(F.sum("score").alias("right"), F.count("*").alias("support"))
        trusted = materialise(
            sums.join(sizes, "pattern")
            .select("pattern", "kind", (F.col("right") / (F.col("n") + CAUTION)).alias("p"), "support")
            .where((F.col("p") >= PATTERN_SCORE) & (F.col("support") >= 3))
            .select("pattern", "kind", F.least("p", F.lit(0.99)).alias("p")),
            f"pii-trusted-{k}",
        )
        reached = (
            edges.join(_few(trusted), "pattern")
            .groupBy("match", "kind")
            .agg((1 - F.exp(F.sum(F.log(1 - F.col("p"))))).alias("score"))
            .join(seeds.select("match").distinct(), "match", "left_anti")
        )
        scores = materialise(seeds.unionByName(reached), f"pii-scores-{k}")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    best = F.max(F.struct("score", -order, "kind"))
    return (
        scores.join(seeds.select("match").distinct(), "match", "left_anti")
        .groupBy("match")
        .agg(best.alias("b"))
        .where(F.col("b.score") >= REPORT_SCORE)
        .select("match", F.col("b.kind").alias("kind"), F.col("b.score").alias("score"))
    )


def find(df: DataFrame, id_col: str = "doc_id", text: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``df`` plus ``spans``: kind, start, end (code points) and whether it is a base span, in order."""
    key = (F.col(id_col).alias("id"), F.xxhash64(F.col(text)).alias("h"))
    matches = materialise(_matches(df.select(*key, F.coalesce(F.col(text), F.lit("")).alias("t"))), "pii-matches")
    checked = matches.withColumn("base", valid(F.col("kind"), F.col("match")))
    digits = F.length(_digits(F.col("match")))
    likely = F.when(F.col("kind") == "mixed", (F.length("match") >= 6) & (digits >= 3)).otherwise(digits >= 7)
    found = materialise(_apart(checked.where(F.col("base") | likely)), "pii-instances")
    more = found.where(~F.col("base")).drop("kind").join(bootstrap(found, rounds).drop("score"), "match")
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    span = F.struct("start", order.alias("rank"), "end", "kind", "base")
    every = found.where("base").unionByName(more.select(*found.columns))
    spans = every.groupBy("id", "h").agg(F.sort_array(F.collect_set(span)).alias("sorted"))
    own = whole(df, key[0].alias("row_id"), key[1].alias("row_h"))
    joined = own.join(spans, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_h") == F.col("h")), "left")
    out = F.transform(
        F.coalesce("sorted", F.array().cast(spans.schema["sorted"].dataType)),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base")),
    )
    return joined.select(*unpacked(df, ["spans"]), out.alias("spans"))
