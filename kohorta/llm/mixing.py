"""Mixes sources to target weights: budgets down a tree, token prefixes of seeded epochs."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from math import ceil, log

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kohorta.llm.common import durable, fresh, query, read_table

LEAF = ["domain", "lang", "source"]
SALTS = 64


@dataclass(frozen=True)
class Mix:
    """Target weights of the tree domain - language - source.

    ``budget`` is the share of all tokens that is asked for, ``epochs`` how often
    a document may be taken. Names without a weight have weight 1; weight 0 takes
    nothing. Sources of a domain and language weigh the same unless listed.
    """

    budget: float = 0.6
    epochs: int = 2
    seed: int = 17
    domains: Mapping[str, int] = field(default_factory=lambda: {"domain0": 4, "domain1": 3, "domain2": 2})
    langs: Mapping[str, int] = field(default_factory=lambda: {"en": 4, "de": 2, "fr": 2})
    sources: Mapping[str, int] = field(default_factory=dict)


def weight_of(name: Column, weights: Mapping[str, int]) -> Column:
    out = None
    for key, w in weights.items():
        out = F.when(name == key, F.lit(float(w))) if out is None else out.when(name == key, F.lit(float(w)))
    return F.lit(1.0) if out is None else out.otherwise(F.lit(1.0))


def domain_of(source: Column) -> Column:
    """Sources are dealt to four domains by the number in their name."""
    number = F.regexp_extract(source, "[0-9]{1,15}$", 0)
    # An empty match casts to null, and a null goes to "other".
    domain = F.when(number != "", number).cast("long") % 4
    return F.coalesce(F.concat(F.lit("domain"), domain.cast("string")), F.lit("other"))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, leaf, n_tokens (words), and the keys that order and mark a row."""
    source = F.coalesce("source", F.lit("(none)"))
    named = docs.select("doc_id", "text", "lang", source.alias("source"))
    return named.select(
        "doc_id",
        domain_of(F.col("source")).alias("domain"),
        F.coalesce("lang", F.lit("(none)")).alias("lang"),
        "source",
        F.coalesce(F.regexp_count("text", F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long").alias("n_tokens"),
        # Rows without an id are told apart by their text.
        F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")))).alias("name"),
        F.xxhash64("text").alias("text_hash"),
    )


def share_out(children: DataFrame, parents: list[str], own: str, budget: str, into: str) -> DataFrame:
    """Shares ``budget`` of the parent among children by weight, within capacity.

    A child that cannot use its share gets its capacity, and its shortage goes to
    its siblings by weight. Children are taken by capacity per weight: one is
    full exactly when the budget lasts up to that level.
    """
    by = Window.partitionBy(*parents) if parents else Window.partitionBy(F.lit(0))
    level = F.col("capacity") / F.col("weight")
    line = by.orderBy(level, own)
    before = F.coalesce(F.sum("capacity").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(line.rowsBetween(0, Window.unboundedFollowing))
    marked = children.withColumn("full", before + level * open_weight <= F.col(budget))
    rest = F.col(budget) - F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).over(by)
    free = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0.0)).over(by)
    share = F.when(F.col("full"), F.col("capacity").cast("double")).otherwise(rest * F.col("weight") / free)
    return marked.withColumn(into, share).drop("full", "weight", "capacity")


def budgets(leaf: DataFrame, mix: Mix) -> DataFrame:
    """One row per leaf: leaf_tokens, and the whole epochs and rest of its budget.

    Capacity (tokens times epochs) goes up the tree, budget comes down: a
    shortage inside a domain is first made good by siblings, as the domain's own
    share was already bounded by what is below it.
    """
    total = leaf.agg(F.floor(F.sum("leaf_tokens") * F.lit(mix.budget)).cast("double").alias("asked"))
    usable = leaf.withColumns(
        {
            "wd": weight_of(F.col("domain"), mix.domains),
            "wl": weight_of(F.col("lang"), mix.langs),
            "ws": weight_of(F.col("source"), mix.sources),
            "capacity": F.col("leaf_tokens") * mix.epochs,
        }
    ).filter("wd > 0 AND wl > 0 AND ws > 0 AND capacity > 0")
    langs = usable.groupBy("domain", "lang").agg(
        F.sum("capacity").alias("capacity"), F.first("wl").alias("weight"), F.first("wd").alias("wd")
    )
    domains = langs.groupBy("domain").agg(F.sum("capacity").alias("capacity"), F.first("wd").alias("weight"))
    domains = domains.withColumn("asked", F.lit(asked(total)))
    domains = share_out(domains, [], "domain", "asked", "of_domain").select("domain", "of_domain")
    langs = share_out(langs.drop("wd").join(domains, "domain"), ["domain"], "lang", "of_domain", "of_lang")
    langs = langs.select("domain", "lang", "of_lang")
    sources = usable.withColumn("weight", F.col("ws")).drop("wd", "wl", "ws").join(langs, ["domain", "lang"])
    sources = share_out(sources, ["domain", "lang"], "source", "of_lang", "share")
    budget = F.floor(F.col("share") + 1e-6)
    whole = F.floor(budget / F.col("leaf_tokens"))
    return sources.select(
        *LEAF, "leaf_tokens", whole.cast("int").alias("whole"), (budget - whole * F.col("leaf_tokens")).alias("rest")
    )


def asked(total: DataFrame) -> float:
    """The budget in tokens: one number, from one row."""
    return total.first()["asked"] or 0.0


def to_rows(rows: DataFrame, leaf: DataFrame) -> DataFrame:
    """Brings leaf columns to rows; a leaf with a third of all rows is spread over salts."""
    salted = leaf.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("name", "text_hash"), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [*LEAF, "salt"]).drop("salt")


def mix_sources(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The documents taken: doc_id, leaf, epoch, n_tokens, take_tokens.

    Each leaf reads its documents in an order that the seed and the epoch give,
    epoch after epoch, and takes tokens until its budget ends; the last document
    may be taken in part (``take_tokens``). The place of a document is found by
    adding up hash ranges first: only the range in which the budget ends is
    sorted. Ranges number about the root of the rows, so neither their list nor
    what is in one becomes large.

    Missing language or source is a leaf of its own, named "(none)". Missing and
    empty texts have no tokens; such a document is taken when the budget lasts
    beyond its place. Repeated rows are taken like different documents.
    """
    rows = durable(leaves(docs))
    leaf = durable(
        rows.groupBy(*LEAF).agg(F.sum("n_tokens").alias("leaf_tokens"), F.count(F.lit(1)).alias("leaf_rows"))
    )
    n = leaf.agg(F.sum("leaf_rows")).first()[0] or 1
    digits = max(1, ceil(log(n, 16) / 2))
    shares = durable(budgets(leaf.drop("leaf_rows"), mix))
    place = F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("whole").cast("string"), "name"))
    placed = to_rows(rows, shares.select(*LEAF, "whole", "rest")).withColumn("place", place)
    placed = durable(placed.withColumn("range", F.substring("place", 1, digits)))
    ranges = placed.filter("rest > 0").groupBy(*LEAF, "range", "rest").agg(F.sum("n_tokens").alias("tokens"))
    line = Window.partitionBy(*LEAF).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("tokens").over(line), F.lit(0)))
    ends = ranges.filter("before < rest").groupBy(*LEAF).agg(
        F.max("range").alias("end_range"), F.max("before").alias("end_before")
    )
    whole = placed.filter("whole > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole") - 1)))
    last = to_rows(placed, ends).filter(F.col("range") <= F.col("end_range")).withColumn("epoch", F.col("whole"))
    inside = last.filter(F.col("range") < F.col("end_range")).withColumn("take_tokens", F.col("n_tokens"))
    order = Window.partitionBy(*LEAF).orderBy("place", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    edge = last.filter(F.col("range") == F.col("end_range")).withColumn(
        "left", F.col("rest") - F.col("end_before") - F.coalesce(F.sum("n_tokens").over(order), F.lit(0))
    )
    edge = edge.filter("left > 0").withColumn("take_tokens", F.least("n_tokens", "left"))
    out = ["doc_id", *LEAF, "epoch", "n_tokens", "take_tokens", "name", "text_hash"]
    return (
        whole.withColumn("take_tokens", F.col("n_tokens")).select(*out)
        .unionByName(inside.select(*out))
        .unionByName(edge.select(*out))
    )


def keep_mixed(docs: DataFrame, mix: Mix) -> DataFrame:
    """The documents taken at least once, whole, with all their columns."""
    mark = fresh(docs, "row_mark")
    taken = mix_sources(docs, mix).select(F.concat_ws(":", "name", "text_hash").alias(mark))
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))
    rows = docs.withColumn(mark, F.concat_ws(":", name, F.xxhash64("text").cast("string")))
    return rows.join(taken, mark, "left_semi").drop(mark)


# The water level of one tree level: rows of {children} share {budget} within {parents}.
_LEVEL = """
  SELECT *, CASE WHEN is_full THEN capacity::DOUBLE
       ELSE ({budget} - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER (PARTITION BY {parents})) * weight
            / sum(CASE WHEN is_full THEN 0.0::DOUBLE ELSE weight END) OVER (PARTITION BY {parents}) END AS {into}
  FROM (SELECT *, coalesce(sum(capacity) OVER (PARTITION BY {parents} ORDER BY capacity / weight, {own}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              + capacity / weight * sum(weight) OVER (PARTITION BY {parents} ORDER BY capacity / weight, {own}
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) <= {budget} AS is_full
        FROM {children})
"""

ORACLE = f"""
WITH rows AS (
  SELECT doc_id, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
         CASE WHEN regexp_extract(source, '[0-9]{{1,15}}$') <> ''
              THEN 'domain' || (CAST(regexp_extract(source, '[0-9]{{1,15}}$') AS BIGINT) % 4) ELSE 'other' END AS domain,
         coalesce(len(regexp_extract_all(text, '[^ \\t-\\r]+')), 0) AS n_tokens,
         coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS name
  FROM documents
), leaf AS (
  SELECT domain, lang, source, sum(n_tokens)::BIGINT AS leaf_tokens, 2 * sum(n_tokens)::BIGINT AS capacity,
         CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END::DOUBLE AS wd,
         CASE lang WHEN 'en' THEN 4 WHEN 'de' THEN 2 WHEN 'fr' THEN 2 ELSE 1 END::DOUBLE AS wl
  FROM rows GROUP BY ALL HAVING sum(n_tokens) > 0
), l AS (
  SELECT domain, lang, sum(capacity)::BIGINT AS capacity, any_value(wl) AS weight, any_value(wd) AS wd FROM leaf GROUP BY ALL
), d AS (
  SELECT domain, sum(capacity)::BIGINT AS capacity, any_value(wd) AS weight,
         (SELECT floor(sum(leaf_tokens) * 0.6::DOUBLE) FROM leaf) AS asked, 0 AS root FROM l GROUP BY domain
), d2 AS ({_LEVEL.format(children="d", parents="root", own="domain", budget="asked", into="of_domain")}),
l1 AS (SELECT l.*, of_domain FROM l JOIN d2 USING (domain)),
l2 AS ({_LEVEL.format(children="l1", parents="domain", own="lang", budget="of_domain", into="of_lang")}),
s1 AS (SELECT leaf.domain, leaf.lang, source, leaf_tokens, leaf.capacity, 1.0::DOUBLE AS weight, of_lang
       FROM leaf JOIN l2 USING (domain, lang)),
s2 AS ({_LEVEL.format(children="s1", parents="domain, lang", own="source", budget="of_lang", into="share")}),
plan AS (
  SELECT domain, lang, source, floor(share + 1e-6)::BIGINT AS budget, leaf_tokens FROM s2
), placed AS (
  SELECT r.*, e.epoch::INT AS epoch, budget,
         e.epoch * leaf_tokens + coalesce(sum(n_tokens) OVER (
            PARTITION BY domain, lang, source, e.epoch
            ORDER BY md5('17:' || e.epoch || ':' || name), n_tokens
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM rows r JOIN plan USING (domain, lang, source) CROSS JOIN (SELECT unnest([0, 1]) AS epoch) e
)
SELECT doc_id, domain, lang, source, epoch, n_tokens, least(n_tokens, budget - before)::BIGINT AS take_tokens
FROM placed WHERE before < budget
   OR (epoch < budget // greatest(1, (SELECT leaf_tokens FROM plan p WHERE p.domain = placed.domain AND p.lang = placed.lang AND p.source = placed.source)))
"""


@query("op8_mix_sources", ORACLE)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read_table(spark, sf_dir, "documents")).drop("name", "text_hash")
