"""Mixing sources to target weights by hierarchical budgeting.

A budget of tokens flows down a tree of domain, language and source.  At every node the children get
shares in proportion to their weights; a child that can't use its share (its supply times the epochs
allowed) keeps what it can, and the rest goes to its siblings by their weights.  As a node's own
capacity is the sum of its children's, a shortage is met among siblings before any of it reaches the
node's ancestors.  A leaf with budget ``b`` and supply ``s`` takes its documents ``b div s`` times
and then the longest prefix of a freshly seeded order whose tokens stay within the remainder.

All of it is integer arithmetic over one row per node.  The prefix is found in two steps: sums
over 4096 ranges of the order's hash per leaf, then the order within the one range that is cut, so a
leaf with most of the rows is not gathered anywhere.

Defined results: null text has no tokens; a null in a tree column is a child of its own; documents
without tokens cost nothing and are taken whenever the prefix reaches them; a leaf without tokens takes its documents
once; repeated rows are taken or left together where they are cut; an empty table gives an empty table; further columns are carried along, and
one that has the name of a result column gets underscores after its name.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import returning_memory, stage, unused_name
from .tokens import encoded, encoder

TREE = ("domain", "lang", "source")
#: Weight of a child at each level; children not named have the weight under None.
WEIGHTS: dict[str, dict[str | None, int]] = {
    "domain": {"d0": 30, "d1": 30, "d2": 20, "d3": 20, None: 10},
    "lang": {"en": 50, "de": 20, "fr": 20, "es": 10, None: 5},
    "source": {None: 1},
}
BUDGET_PERCENT = 80
MAX_EPOCHS = 2
SEED = "mix-1"


def with_domain(docs: DataFrame, source_col: str = "source", name: str = "domain") -> DataFrame:
    """A domain for sources that name none: one of four by the source's hash."""
    digit = F.conv(F.substring(F.md5(F.coalesce(F.col(source_col), F.lit(""))), 1, 1), 16, 10).cast("int")
    return docs.withColumn(name, F.concat(F.lit("d"), (digit % 4).cast("string")))


def token_estimate(text: Column) -> Column:
    """Four bytes of UTF-8 to a token, rounded up."""
    return F.coalesce(F.floor((F.octet_length(text) + 3) / 4), F.lit(0)).cast("long")


def token_count(text: Column, vocabulary: str | None = None) -> Column:
    """Ids of the text by the vocabulary; for a column to be staged, as ``mix`` reads it several times."""

    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        held = encoder(vocabulary)  # for the whole task
        for texts in batches:
            n = np.zeros(len(texts), np.int64)
            for row, ids in encoded(pa.RecordBatch.from_arrays([texts], ["text"]), "text", held.vocabulary):
                n[row] = len(ids)
            yield pa.array(n)

    return F.arrow_udf(returning_memory(count), "long", F.ArrowUDFType.SCALAR_ITER)(text)


def _weight(level: str, weights: Mapping[str, Mapping[str | None, int]]) -> Column:
    named = weights.get(level, {})
    out = F.lit(named.get(None, 1))
    for child, weight in named.items():
        if child is not None:
            out = F.when(F.col(f"__n_{level}") == child, F.lit(weight)).otherwise(out)
    return out.cast("decimal(10,0)")


def _fill(nodes: DataFrame, parent: Sequence[str], child: str) -> DataFrame:
    """Deal ``__budget`` of each parent to its children: ``__share`` for every row of ``nodes``.

    Children are taken by rising capacity per weight.  One is full if its capacity is at most its
    share of what is left before it; the first that isn't, and all after it, divide the rest.
    """
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(F.col("__cap").cast("double") / F.col("__w").cast("double"), child)
    done = order.rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.select(
        "*",
        (F.col("__budget") - F.coalesce(F.sum("__cap").over(done), F.lit(0))).cast("decimal(24,0)").alias("__left"),
        (F.sum("__w").over(by) - F.coalesce(F.sum("__w").over(done), F.lit(0))).cast("decimal(12,0)").alias("__wleft"),
    )
    full = F.col("__cap") * F.col("__wleft") <= F.col("__w") * F.col("__left")
    nodes = nodes.withColumn("__full", full)
    first = F.min(F.when(~F.col("__full"), F.struct(F.col("__cap").cast("double") / F.col("__w").cast("double"), child, "__left", "__wleft")))
    nodes = nodes.withColumn("__first", first.over(by))
    part = F.expr("cast((__first.__left * __w) div __first.__wleft as decimal(24,0))")
    return nodes.withColumn("__share", F.when(F.col("__full"), F.col("__cap")).otherwise(part)).drop(
        "__left", "__wleft", "__full", "__first"
    )


def leaf_budgets(
    leaves: DataFrame,
    tree: Sequence[str] = TREE,
    weights: Mapping[str, Mapping[str | None, int]] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``leaves`` (node columns ``__n_<level>`` and ``__supply``) with ``__budget``."""
    names = [f"__n_{x}" for x in tree]
    leaves = leaves.withColumn("__cap", (F.col("__supply") * max_epochs).cast("decimal(24,0)"))
    budgets: DataFrame | None = None
    for depth, level in enumerate(tree):
        nodes = leaves.groupBy(*names[: depth + 1]).agg(
            F.sum("__cap").cast("decimal(24,0)").alias("__cap"), F.sum("__supply").alias("__supply")
        )
        nodes = nodes.withColumn("__w", _weight(level, weights))
        if budgets is None:
            # the whole budget, over one row per child of the root
            whole = F.sum("__supply").over(Window.partitionBy(F.lit(0)))
            nodes = nodes.withColumn("__all", whole).withColumn(
                "__budget", F.expr(f"cast((__all * {budget_percent}) div 100 as decimal(24,0))")
            )
        else:
            nodes = nodes.join(budgets, names[:depth])
        budgets = _fill(nodes, names[:depth], names[depth]).select(
            *names[: depth + 1], F.col("__share").alias("__budget")
        )
    return leaves.join(budgets, names)


def mix(
    docs: DataFrame,
    tokens: Column,
    tree: Sequence[str] = TREE,
    weights: Mapping[str, Mapping[str | None, int]] = WEIGHTS,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    id_col: str = "doc_id",
    tokens_name: str = "n_tokens",
    copies_name: str = "copies",
) -> DataFrame:
    """``docs`` with their tokens and ``copies``, the number of epochs that take the document."""
    names = [f"__n_{x}" for x in tree]
    # columns go by number meanwhile, so that theirs and the working names can't clash
    held = [F.col(f"`{c.replace('`', '``')}`").alias(f"in{k}") for k, c in enumerate(docs.columns)]
    rows = docs.select(*held, F.col(id_col).cast("string").alias("__id"), tokens.alias("__tokens"), *[
        F.coalesce(F.col(x).cast("string"), F.lit("\x00none")).alias(f"__n_{x}") for x in tree
    ])
    leaves = stage(rows.groupBy(*names).agg(F.sum("__tokens").alias("__supply")), "leaves")
    # written tables have a known size: Spark broadcasts them below its threshold, so texts stay in
    # place, and joins by shuffle above it
    plan = leaf_budgets(leaves, tree, weights, budget_percent, max_epochs).select(
        *names,
        "__supply",
        F.expr("if(__supply > 0, cast(__budget as bigint) div __supply, 0)").alias("__epochs"),
        F.expr("if(__supply > 0, cast(__budget as bigint) % __supply, 0)").alias("__rest"),
    )
    plan = stage(plan.coalesce(1), "budgets")
    rank = F.md5(F.concat_ws(":", F.lit(seed), (F.col("__epochs") + 1).cast("string"), F.coalesce("__id", F.lit(""))))
    ranked = rows.join(plan, names).withColumn("__rank", rank).withColumn("__range", F.substring("__rank", 1, 3))
    sums = ranked.groupBy(*names, "__range", "__rest").agg(F.sum("__tokens").alias("__n"))
    upto = F.sum("__n").over(Window.partitionBy(*names).orderBy("__range"))
    # the range in which the prefix ends: what lies before it is taken, what lies after it isn't
    cut = (
        sums.withColumn("__upto", upto)
        .where("__upto > __rest")
        .groupBy(*names)
        .agg(F.min(F.struct("__range", (F.col("__upto") - F.col("__n")).alias("before"))).alias("__cut"))
    )
    ranked = ranked.join(stage(cut.coalesce(1), "cuts"), names, "left")
    takes = F.expr("__rest > 0 or __supply = 0")
    whole = F.coalesce(F.col("__range") < F.col("__cut.__range"), F.lit(True))
    inside = F.coalesce(F.col("__range") == F.col("__cut.__range"), F.lit(False))
    clear = ranked.where(~inside).withColumn("__in", takes & whole)
    order = Window.partitionBy(*names).orderBy("__rank")  # rows of the cut range only; equal ranks together
    edge = ranked.where(inside).withColumn(
        "__in", takes & (F.sum("__tokens").over(order) + F.col("__cut.before") <= F.col("__rest"))
    )
    results = [tokens_name, copies_name]
    shown: list[str] = []
    for c in docs.columns:
        shown.append(unused_name([*results, *shown, *docs.columns], c) if c.lower() in map(str.lower, results) else c)
    return clear.unionByName(edge).select(
        *[F.col(f"in{k}").alias(c) for k, c in enumerate(shown)],
        F.col("__tokens").alias(tokens_name),
        (F.col("__epochs") + F.col("__in").cast("int")).cast("int").alias(copies_name),
    )


def repeated(mixed: DataFrame, columns: Sequence[str], copies_name: str = "copies") -> DataFrame:
    """Each document as often as its epochs take it."""
    return mixed.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col(copies_name)))).select(*columns)


def oracle(
    tree: Sequence[str] = TREE,
    budget_percent: int = BUDGET_PERCENT,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    tokens: str = "(coalesce(strlen(text), 0) + 3) // 4",
) -> str:
    """DuckDB SQL for the mixing of ``documents``: the same rule with plain windows, over the expression ``tokens``."""
    digits = " ".join(f"when '{d:x}' then 'd{d % 4}'" for d in range(16))

    def weight(level: str) -> str:
        cases = " ".join(f"when '{c}' then {w}" for c, w in WEIGHTS[level].items() if c is not None)
        other = WEIGHTS[level].get(None, 1)
        return f"case n_{level} {cases} else {other} end" if cases else str(other)

    ctes = [
        f"""rows as (select doc_id, case substr(md5(coalesce(source, '')), 1, 1) {digits} end as n_domain,
  coalesce(lang, chr(1)) as n_lang, coalesce(source, chr(1)) as n_source,
  cast({tokens} as bigint) as n_tokens from documents)""",
        f"""leaf as (select n_domain, n_lang, n_source, cast(sum(n_tokens) as bigint) as supply,
  cast(sum(n_tokens) as hugeint) * {max_epochs} as cap from rows group by all)""",
        f"b0 as (select cast((sum(supply) * {budget_percent}) // 100 as hugeint) as budget from leaf)",
    ]
    names = [f"n_{x}" for x in tree]
    for depth, level in enumerate(tree):
        keys = ", ".join(names[: depth + 1])
        parent = ", ".join(names[:depth])
        by = f"partition by {parent}" if parent else ""
        source = f"join b{depth} using ({parent})" if parent else ", b0"
        d = depth + 1
        ctes += [
            f"""k{d} as (select n.*, budget, {weight(level)} as w from (select {keys}, sum(cap) as cap from leaf group by all) n {source})""",
            f"""l{d} as (select *, budget - coalesce(sum(cap) over (p order by cast(cap as double) / w, {names[depth]} rows between unbounded preceding and 1 preceding), 0) as rest_b,
  sum(w) over p - coalesce(sum(w) over (p order by cast(cap as double) / w, {names[depth]} rows between unbounded preceding and 1 preceding), 0) as rest_w,
  row_number() over (p order by cast(cap as double) / w, {names[depth]}) as k from k{d} window p as ({by}))""",
            f"f{d} as (select *, cap * rest_w <= w * rest_b as full_ from l{d})",
            f"u{d} as (select *, min(case when not full_ then k end) over ({by}) as u from f{d})",
            f"""b{d} as (select {', '.join(f'a.{x}' for x in names[:d])}, cast(case when a.full_ then a.cap else (z.rest_b * a.w) // z.rest_w end as hugeint) as budget
  from u{d} a left join u{d} z on z.k = a.u {''.join(f' and z.{x} = a.{x}' for x in names[:depth])})""",
        ]
    ctes += [
        f"""plan as (select *, case when supply > 0 then cast(budget // supply as bigint) else 0 end as epochs,
  case when supply > 0 then cast(budget % supply as bigint) else 0 end as rest from leaf join b{len(tree)} using ({', '.join(names)}))""",
        f"""r as (select *, md5('{seed}:' || (epochs + 1) || ':' || coalesce(cast(doc_id as varchar), '')) as rk
  from rows join plan using ({', '.join(names)}))""",
        f"c as (select *, sum(n_tokens) over (partition by {', '.join(names)} order by rk) as upto from r)",
    ]
    return (
        "with " + ",\n".join(ctes) + """
select doc_id, n_domain as domain, nullif(n_lang, chr(1)) as lang, nullif(n_source, chr(1)) as source, n_tokens,
  cast(epochs + case when (rest > 0 or supply = 0) and upto <= rest then 1 else 0 end as integer) as copies from c"""
    )
