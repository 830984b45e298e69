"""How filters over documents overlap, in every order they could be applied.

Each filter fails or passes a document by itself, so a document is a mask of
failed filters and all orders can be answered from the counts of the masks:
one row for each part (language) holds its *mask cells*. A recursive query
extends filter prefixes by one unused letter at a time, joins the cells of
the part, carries the bits applied so far and emits the counts of the step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rillmark.llm.tables import cut

LETTERS = "ABCDE"
#: Parts of one recursion: 326 rows each, so it stays below Spark's limit of a million rows.
PARTS_TOGETHER = 1500
SEPARATORS = r"[ \t-\r]+"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_failures(text: Column) -> dict[str, Column]:
    """The filters that look at one text alone, by letter; true means failed. Null is empty.

    A: under 200 words. B: under half of the words distinct. C: over 3 % of
    the characters are A-Z. D: holds one of ``#$%&*|``. Words are maximal runs
    without white space.
    """
    whole = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(whole, SEPARATORS), "")
    n_words, n_distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.octet_length(F.regexp_replace(whole, "[^A-Z]+", "")).cast("long")
    return {
        "A": n_words < 200,
        "B": n_distinct * 100 < n_words * 50,
        "C": capitals * 100 > F.length(whole).cast("long") * 3,
        "D": whole.rlike("[#$%&*|]"),
    }


def _bits(failed: dict[str, Column]) -> Column:
    return sum((F.when(c, 1 << LETTERS.index(letter)).otherwise(0) for letter, c in failed.items()), F.lit(0))


def mask_cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """``(part, mask, n, good, toxic)``: documents of each part by the set of filters they fail.

    E fails a document whose text is also that of a smaller id, anywhere in
    the table. Rows of one id and text are all first or all later ones; a row
    without an id has no smaller id, is no one's smaller id and takes no
    labels. A document with several label rows is good (toxic) if one of them
    says so. Null text is the empty text, a null part the empty part.

    Texts travel as SHA-256 digests. Copies are counted inside map tasks for
    each digest, part and label, so a text that fills a third of the table
    reaches the comparison with other parts as a handful of rows.
    """
    text, part = F.col(text_col), F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    digest = F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))
    rows = docs.select(F.col(id_col).alias("id"), part.alias("part"), _bits(text_failures(text)).alias("mask"), digest.alias("digest"))
    rows = rows.groupBy("id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("label_id")).agg(
        F.max((F.coalesce(F.col("quality") == 1, F.lit(False))).cast("int")).alias("good"),
        F.max((F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int")).alias("toxic"),
    )
    rows = rows.join(marks, F.col("id") == F.col("label_id"), "left").na.fill(0, ["good", "toxic"])

    # Ids differ inside a group, so the count beside the smallest id is that of all its rows.
    nameless = F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless")
    copies = rows.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("id").alias("low"), F.min_by("n", "id").alias("n_low"), nameless
    )
    lowest = F.min("low").over(Window.partitionBy("digest"))
    first = F.col("nameless") + F.when(F.col("low") == F.col("lowest"), F.col("n_low")).otherwise(0)
    e = 1 << LETTERS.index("E")
    split = F.array(F.struct(F.col("mask"), first.alias("n")), F.struct((F.col("mask") + e).alias("mask"), (F.col("n") - first).alias("n")))
    parted = copies.withColumn("lowest", lowest).select("part", "good", "toxic", F.inline(split)).filter("n > 0")
    return parted.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"), F.sum(F.col("n") * F.col("toxic")).alias("toxic")
    )


#: One level of the recursion for each step. ``cells`` has a row for each part with its mask cells in an array.
STEPS = """
with recursive steps (part, prefix, applied, step, letter, kept, removed, redundant, unique_fails, good_lost, toxic_lost) as (
  select part, '', 0, 0, '', 0L, 0L, 0L, 0L, 0L, 0L from {cells}
  union all
  select s.part, concat(s.prefix, u.unused.letter), s.applied | u.unused.bit, s.step + 1, u.unused.letter,
    aggregate(c.cells, 0L, (t, x) -> t + if(x.mask & (s.applied | u.unused.bit) = 0, x.n, 0L)),
    aggregate(c.cells, 0L, (t, x) -> t + if(x.mask & s.applied = 0 and x.mask & u.unused.bit <> 0, x.n, 0L)),
    aggregate(c.cells, 0L, (t, x) -> t + if(x.mask & s.applied <> 0 and x.mask & u.unused.bit <> 0, x.n, 0L)),
    aggregate(c.cells, 0L, (t, x) -> t + if(x.mask = u.unused.bit, x.n, 0L)),
    aggregate(c.cells, 0L, (t, x) -> t + if(x.mask & s.applied = 0 and x.mask & u.unused.bit <> 0, x.good, 0L)),
    aggregate(c.cells, 0L, (t, x) -> t + if(x.mask & s.applied = 0 and x.mask & u.unused.bit <> 0, x.toxic, 0L))
  from steps s join {cells} c on s.part = c.part
  lateral view explode(filter(array({letters}), l -> s.applied & l.bit = 0)) u as unused
)
select * from steps where step > 0
"""


def prefix_metrics(spark: SparkSession, cells: DataFrame, letters: str = LETTERS) -> DataFrame:
    """Counts of the last step of every filter prefix and part: ``(part, prefix, step, letter, ...)``."""
    packed = cut(cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")), "cells")
    groups = max(1, -(-packed.count() // PARTS_TOGETHER))
    choices = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << i})" for i, x in enumerate(letters))
    found = None
    for g in range(groups):
        mine = packed.filter(F.pmod(F.xxhash64("part"), F.lit(groups)) == g)
        steps = spark.sql(STEPS.replace("{letters}", choices), cells=mine).drop("applied")
        found = steps if found is None else found.union(steps)
    return cut(found, "filter-steps")


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row for each part, order of the five filters and step, with the counts of that step.

    ``shapley`` is what the step's filter removes, summed over all orders. An
    empty table has no parts and gives no rows.
    """
    steps = prefix_metrics(docs.sparkSession, mask_cells(docs, labels, id_col, text_col, part_col))
    whole = steps.filter(F.col("step") == len(LETTERS)).select("part", F.col("prefix").alias("filter_order"))
    at = whole.select("part", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step"))
    rows = at.withColumn("prefix", F.substring("filter_order", F.lit(1), F.col("step"))).join(steps, ["part", "prefix", "step"])
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter")).alias("shapley")
    return rows.select("part", "filter_order", "step", *COUNTS, shapley)


def oracle() -> str:
    return r"""
with recursive docs as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
marks as (
  select doc_id, max(case when quality = 1 then 1 else 0 end) as good, max(case when toxic = 1 then 1 else 0 end) as toxic
  from labels group by doc_id),
masks as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    case when len(w) < 200 then 1 else 0 end
    + case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end
    + case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) then 4 else 0 end
    + case when regexp_matches(t, '[#$%&*|]') then 8 else 0 end
    + case when doc_id > min(doc_id) over (partition by t) then 16 else 0 end as mask
  from docs left join marks using (doc_id)),
cells as (select part, mask, count(*) as n, sum(good) as good, sum(toxic) as toxic from masks group by part, mask),
letters as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) l(letter, bit)),
orders as (
  select '' as prefix, 0 as applied, 0 as step, 0 as bit, 0 as before, '' as letter
  union all
  select prefix || l.letter, applied + l.bit, step + 1, l.bit, applied, l.letter from orders join letters l on applied & l.bit = 0),
steps as (
  select part, prefix, step, letter,
    sum(case when mask & applied = 0 then n else 0 end) as kept,
    sum(case when mask & before = 0 and mask & bit <> 0 then n else 0 end) as removed,
    sum(case when mask & before <> 0 and mask & bit <> 0 then n else 0 end) as redundant,
    sum(case when mask = bit then n else 0 end) as unique_fails,
    sum(case when mask & before = 0 and mask & bit <> 0 then good else 0 end) as good_lost,
    sum(case when mask & before = 0 and mask & bit <> 0 then toxic else 0 end) as toxic_lost
  from orders, cells where step > 0 group by all),
rows as (
  select s.*, o.prefix as filter_order, sum(removed) over (partition by part, s.letter) as shapley
  from orders o join steps s on starts_with(o.prefix, s.prefix) where o.step = 5)
select part, filter_order, step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant,
  unique_fails::bigint as unique_fails, good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, shapley::bigint as shapley
from rows
"""
