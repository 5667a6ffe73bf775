"""Features after late rows: only what they reach is computed anew.

Rows of a key are cut into chunks of as many *sound* rows (a positive, finite
price, so that returns are there too) as any feature looks back over, through
all the features that it is made of. A late row then reaches rows of its own
chunk and the next; these, the chunk before each as what windows look back over,
and nothing else go through the feature graph again. All other rows keep the
values that they had. What an exponential mean has from further back than its
reach weighs under ``features.EMA_REST``, as in a full run.

Features over emitted values other than price and its returns may look back any
number of rows; with such a graph a late row reaches all later rows of its key.

Keys without late rows are not touched, but for a broadcast or shuffled semi
join; the chunks of the others are counted by ranges (``operators.scan``), so no
key is one task's work. Null keys are a key. Repeated rows each count. Without
late rows nothing is computed; without old rows, all rows are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalbook.operators.scan import AUTO, Width, fresh, running, spread
from tidalbook.plans import features
from tidalbook.plans.definitions import FeatureSet, Node


def reach(feature_set: FeatureSet) -> int | None:
    """How many sound rows back any feature looks, through its inputs; None if that has no bound."""
    made: dict[str, Node] = {n.name: n for n in feature_set.nodes}

    def deep(n: Node) -> int:
        own = features._reach(n) if n.kind in (*features.BY_COUNT, "rolling") else int(n.kind == "return")
        return own + max((deep(made[i]) for i in n.inputs if i in made and i != n.name), default=0)

    def sound(name: str) -> bool:
        n = made.get(name)
        return name == "price" or (n is not None and (n.kind == "price" or (n.kind == "return" and all(sound(i) for i in n.inputs))))

    if any((n.kind in features.BY_COUNT or features._is_ema(n)) and not sound(n.inputs[0]) for n in feature_set.nodes):
        return None
    return max((deep(n) for n in feature_set.nodes), default=0) + 1


def recompute(made: DataFrame, late: DataFrame, feature_set: FeatureSet, order: Sequence[str] = features.ORDER, width: Width = AUTO, mark: str = "recomputed") -> DataFrame:
    """Rows of ``made`` (events with their features) and ``late`` (events), with the features of a full run.

    ``mark`` is true for rows whose features were computed now.
    """
    keys, names = list(feature_set.keys), [n.name for n in feature_set.nodes if n.name != "price"]
    own = [c for c in made.columns if c not in names and c != mark]
    is_late, seen, chunk, touched, needed, *of = fresh([*made.columns, mark], "is_late", "sound_before", "chunk", "touched", "needed", *[f"of_{k}" for k in keys], "of_chunk")
    new = late.where(features.finite(F.col("price"))).select(*own)
    hit = new.select(*[F.col(k).alias(o) for k, o in zip(keys, of, strict=False)]).distinct()
    same_key = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, of, strict=False)]
    calm = made.join(hit, same_key, "left_anti").withColumn(mark, F.lit(False))

    both = made.join(hit, same_key, "left_semi").withColumn(is_late, F.lit(False)).unionByName(new.withColumn(is_late, F.lit(True)), allowMissingColumns=True)
    span = reach(feature_set)
    width = spread(made, keys, order, width)
    if span is None:
        from_here = running(both, keys, order, "max", F.col(is_late).cast("int"), touched, width)
        rows = from_here.withColumns({touched: F.col(touched) == 1, needed: F.lit(True)})
    else:
        numbered = running(both, keys, order, "count", F.when(F.col("price") > 0, 1), seen, width, inclusive=False)
        rows = numbered.withColumn(chunk, F.floor(F.coalesce(F.col(seen), F.lit(0)) / span))
        hits = rows.where(is_late).select(*keys, F.explode(F.array(F.col(chunk), F.col(chunk) + 1)).alias(chunk))
        wanted = hits.select(*keys, F.explode(F.array(F.struct(F.col(chunk).alias(chunk), F.lit(True).alias(touched)), F.struct((F.col(chunk) - 1).alias(chunk), F.lit(False).alias(touched)))).alias("w")).select(*keys, "w.*")
        wanted = wanted.groupBy(*keys, chunk).agg(F.max(touched).alias(touched)).withColumnsRenamed(dict(zip([*keys, chunk], of, strict=True)))
        on = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip([*keys, chunk], of, strict=True)]
        rows = rows.join(wanted, on, "left").withColumn(needed, F.col(touched).isNotNull()).withColumn(touched, F.coalesce(F.col(touched), F.lit(False))).drop(*of)
    kept = rows.where(~F.col(touched)).select(*own, *names).withColumn(mark, F.lit(False))
    again = features.compute(rows.where(needed).select(*own, touched), feature_set, order, width=width)
    again = again.where(touched).select(*own, *names).withColumn(mark, F.lit(True))
    return calm.select(*own, *names, mark).unionByName(kept).unionByName(again)
