"""Secrets in texts, and credentials made of several parts.

Strong patterns are always reported. Identifiers, short secrets and endpoints are weak on their own: they are reported
only where the parts that complete them stand within the same scope, which an interval join finds. Both sides of that
join are cut into bins as long as a scope; of each text, bin and role only the first start and the last end are kept, so
a text with very many parts joins each part with three bins, not with every other part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Code points between two parts that still belong together.
SCOPE = 160
MARK = "[SECRET]"

_VALUE = r"""["']?\x20*[:=]\x20*["']?"""


@dataclass(frozen=True)
class Kind:
    name: str
    role: str
    pattern: str
    least: int  # length that group 1, or the match where there is none, must have
    strong: bool
    needs: tuple[tuple[str, ...], ...] = ()  # one role of each group has to be near


# The first three patterns are fixed values.
KINDS = [
    Kind("assign", "secret", rf"(?i)(?:password|passwd|secret|token|api_?key){_VALUE}([A-Za-z0-9+/_.=-]+)", 6, True),
    Kind("access", "identifier", r"(AKIA[A-Z0-9]{16,})", 20, True),
    Kind("hex", "secret", r"((?<![0-9a-f])[0-9a-f]{24,})", 24, True),
    Kind(
        "weak_id",
        "identifier",
        rf"(?i)(?<![a-z0-9_])(?:user(?:name)?|login|client_?id|account){_VALUE}([a-z0-9@_.+-]+)",
        3,
        False,
        (("secret",),),
    ),
    Kind(
        "weak_secret",
        "secret",
        rf"(?i)(?<![a-z0-9_])(?:pass|pwd|pin|key|auth|credentials?){_VALUE}([a-z0-9+/_.=-]+)",
        4,
        False,
        (("identifier", "endpoint"),),
    ),
    Kind(
        "endpoint",
        "endpoint",
        r"""((?:https?|ftp|ssh|redis|amqp|mysql|postgres(?:ql)?)://[^\x20\x09-\x0D"'<>]+)""",
        8,
        False,
        (("identifier",), ("secret",)),
    ),
]
ROLES = ["identifier", "secret", "endpoint"]


def _cuts(text: Column, kind: Kind) -> Column:
    """Per match in order: code points before it since the last match, its own, and whether it is long enough."""
    pattern = F.lit(kind.pattern)
    found = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, 0).alias("match"),
        F.regexp_extract_all(text, pattern, 1).alias("value"),
    )
    cuts = F.transform(
        found,
        lambda m: F.struct(
            F.char_length(m["gap"]).alias("gap"),
            F.char_length(m["match"]).alias("size"),
            (F.char_length(m["value"]) >= kind.least).alias("good"),
        ),
    )
    # What follows the last match has no match beside it.
    matches = F.filter(cuts, lambda m: m["size"].isNotNull())
    none = F.array().cast("array<struct<gap:int,size:int,good:boolean>>")
    return F.when(F.regexp_like(text, pattern), matches).otherwise(none)


def text_key(text: Column) -> Column:
    """What stands for a text in joins: equal texts have equal spans."""
    return F.md5(text.cast("binary"))


def _parts(docs: DataFrame) -> DataFrame:
    """(key, kind, start, end) of every candidate of each different text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = [k.name for k in KINDS]
    texts = docs.select(text.alias("text")).select(
        text_key(F.col("text")).alias("key"), *[_cuts(F.col("text"), k).alias(k.name) for k in KINDS]
    )
    some = texts.where(F.greatest(*[F.size(n) for n in names]) > 0)
    once = some.groupBy("key").agg(*[F.any_value(n).alias(n) for n in names])
    by_kind = once.select(
        "key",
        F.explode(F.array(*[F.struct(F.lit(i).alias("kind"), F.col(n).alias("cuts")) for i, n in enumerate(names)])),
    ).select("key", "col.kind", F.posexplode("col.cuts").alias("place", "cut"))
    before = Window.partitionBy("key", "kind").orderBy("place")
    end = F.sum(F.col("cut.gap") + F.col("cut.size")).over(before)
    placed = by_kind.select("key", "kind", (end - F.col("cut.size")).alias("start"), end.alias("end"), "cut.good")
    return placed.where("good").drop("good")


def _by_kind(values: list, of: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), of + 1)


def _linked(parts: DataFrame, scope: int) -> DataFrame:
    """The weak parts whose complement is within ``scope`` code points."""
    role = _by_kind([k.role for k in KINDS], F.col("kind"))
    bins = F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor((F.col("end") - 1) / scope)))
    held = parts.select("key", role.alias("role"), "start", "end", bins.alias("bin"))
    limits = [
        pick(F.when(F.col("role") == r, F.col(c))).alias(f"{r}_{c}")
        for r in ROLES
        for pick, c in ((F.min, "start"), (F.max, "end"))
    ]
    summary = held.groupBy("key", "bin").agg(*limits)
    weak = parts.where(F.col("kind").isin([i for i, k in enumerate(KINDS) if not k.strong]))
    around = F.explode(
        F.sequence(F.floor(F.col("start") / scope) - 1, F.floor((F.col("end") - 1) / scope) + 1)
    )
    near = {
        r: F.bool_or((F.col(f"{r}_start") <= F.col("end") + scope) & (F.col(f"{r}_end") >= F.col("start") - scope))
        for r in ROLES
    }
    met = (
        weak.withColumn("bin", around)
        .join(summary, ["key", "bin"])
        .groupBy("key", "kind", "start", "end")
        .agg(*[F.coalesce(found, F.lit(False)).alias(r) for r, found in near.items()])
    )
    complete = F.lit(False)
    for i, kind in enumerate(KINDS):
        if not kind.strong:
            rule = F.lit(True)
            for group in kind.needs:
                rule = rule & F.greatest(*[F.col(r) for r in group], F.lit(False))
            complete = complete | ((F.col("kind") == i) & rule)
    return met.where(complete).select("key", "kind", "start", "end")


def _spans(docs: DataFrame, scope: int) -> DataFrame:
    """(key, spans): the reported spans of each different text that has any, by start and kind."""
    parts = _parts(docs)
    strong = parts.where(F.col("kind").isin([i for i, k in enumerate(KINDS) if k.strong]))
    reported = strong.unionByName(_linked(parts, scope))
    return reported.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("spans"))


def _written(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_weak) of every row.

    Spans are counted in code points, the end excluded. A null text is empty and has none. Repeated rows and equal texts
    get equal results, ids may be null, other columns are not read, and an empty table gives none. Overlapping spans of
    different kinds are all reported.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text_key(text).alias("key"))
    found = rows.join(_spans(docs, scope), "key", "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    base = F.filter(F.col("spans"), lambda s: s["kind"] < 3)
    number = lambda k: F.size(F.filter(F.col("spans"), lambda s: s["kind"] == k)).cast("long")
    return found.withColumn("spans", spans).select(
        "doc_id",
        *[number(i).alias(f"n_{KINDS[i].name}") for i in range(3)],
        F.sha2(_written(base).cast("binary"), 256).alias("base_sha256"),
        _written(F.col("spans")).alias("spans"),
        F.size(F.filter(F.col("spans"), lambda s: s["kind"] >= 3)).cast("long").alias("n_weak"),
    )


def redact(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with every reported span replaced by a mark; ``n_chars`` is kept true where there is such a column.

    Overlapping spans become one mark. Texts without spans, null ones included, stay as they are.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = _spans(docs, scope).select(F.col("key").alias("__key"), F.explode("spans").alias("s"))
    rows = found.select("__key", "s.start", "s.end")
    order = Window.partitionBy("__key").orderBy("start", "end")
    earlier = F.coalesce(F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    steps = rows.withColumn("from", earlier).where(F.col("end") > F.col("from"))
    cuts = steps.groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("from", "start", "end"))).alias("__cuts"))
    piece = lambda c: F.concat(
        F.substring(F.col("text"), (c["from"] + 1).cast("int"), F.greatest(c["start"] - c["from"], F.lit(0)).cast("int")),
        F.when(c["start"] >= c["from"], F.lit(MARK)).otherwise(F.lit("")),
    )
    rest = F.expr("substring(text, cast(element_at(__cuts, -1).end + 1 as int))")
    clean = F.concat(F.array_join(F.transform("__cuts", piece), ""), rest)
    joined = docs.withColumn("__key", text_key(text)).join(cuts, "__key", "left")
    result = joined.withColumn("text", F.when(F.col("__cuts").isNull(), F.col("text")).otherwise(clean))
    if "n_chars" in docs.columns:
        changed = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        result = result.withColumn("n_chars", F.when(F.col("__cuts").isNull(), F.col("n_chars")).otherwise(changed))
    return result.select(*docs.columns)
