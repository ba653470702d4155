"""Mixing sources to target weights by iterative proportional fitting.

Token weights are counted in the cells of source, language and topic, a partial aggregate.
Raking then scales the cells to one marginal after the other (source, language, topic, again
and again) until every marginal holds its target within ``tolerance``. What is raked is the
odds of a cell's documents, and what a cell gives is its tokens by its odds, at most all: a
full cell stays full and the others are raked on, so no document is asked for twice and no
target is given up. The scale is a share ``keep`` of all tokens, or less where a marginal value has too
few: no value gives more than ``fill`` of its tokens. But it doesn't fall below ``least``, however scarce a value
is: what a full one lacks of its target is shared out among the others of its marginal in proportion to theirs. A document is kept with the probability
of its cell; the draw is a hash of its id: the same documents whatever the partitioning.

Should targets contradict each other over the cells that exist, raking ends after ``rounds`` with a
warning that says how far off it is; ``report`` shows every marginal's target and what is expected.

DataFrame functions only. The cells are as many as the marginals' values allow, apart from the
documents; only they are iterated on, and a source that holds a third of all documents is a
few cells.

Targets name shares of marginal values. Values that aren't named share what is left of one in
proportion to their tokens; where nothing is left they keep their own share of all tokens. Values
that don't occur are left out. Null marginal values are a value of their own. Tokens are words here;
a text without words, a null one included, weighs one, and a very long one all its words. An empty table gives no rows. Equal
ids are kept or dropped together, as null ids are. Extra columns, clashing names included, are carried as they are.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, free_name, spool, table

#: Target shares by marginal and value.
TARGETS: dict[str, dict[str, float]] = {
    "source": {"src0": 0.1},
    "lang": {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2},
    "topic": {"t0": 0.15},
}
_NONE = "\\N"


def topic_of(text: Column, topics: int = 8) -> Column:
    """A stand-in topic, where documents carry none: the first word's hash class."""
    digit = F.substring(F.md5(F.lower(F.regexp_extract(F.coalesce(text, F.lit("")), WORD_PATTERN, 0))), 1, 1)
    return F.concat(F.lit("t"), ((F.instr(F.lit("0123456789abcdef"), digit) - 1) % topics).cast("string"))


def token_weight(text: Column) -> Column:
    return F.greatest(F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)), F.lit(1)).cast("long")


def shares(cells: DataFrame, margin: str, named: dict[str, float]) -> DataFrame:
    """(margin, n, share) of every value: its tokens and its target share."""
    share = F.lit(None).cast("double")
    for value, x in named.items():
        share = F.when(F.col(margin) == value, F.lit(float(x))).otherwise(share)
    values = cells.groupBy(margin).agg(F.sum("tokens").cast("double").alias("n")).withColumn("_s", share)
    given, other, whole = values.agg(F.coalesce(F.sum("_s"), F.lit(0.0)), F.coalesce(F.sum(F.when(F.col("_s").isNull(), F.col("n"))), F.lit(0.0)), F.coalesce(F.sum("n"), F.lit(1.0))).first()
    if not other:
        target = F.col("_s") / F.lit(given or 1.0)
    elif given < 1:
        target = F.coalesce("_s", F.lit(1 - given) * F.col("n") / F.lit(other))
    else:
        target = F.coalesce(F.col("_s") / F.lit(given) * F.lit(1 - other / whole), F.col("n") / F.lit(whole))
    return values.select(margin, "n", target.alias("share"))


def within_reach(values: DataFrame, wanted: float, fill: float) -> DataFrame:
    """values (n, share) with the shares of ``wanted`` tokens that they can give: at most ``fill`` of what each
    has; what a full one lacks goes to the others in proportion to their shares. The shares are
    least(limit, level x share), and the level rises, an aggregate a step, until it fills no other value."""
    limit = F.col("n") * F.lit(fill / wanted)
    level = 1.0
    while True:
        full = F.lit(level) * F.col("share") > limit
        held, open_, n = values.agg(F.coalesce(F.sum(F.when(full, limit)), F.lit(0.0)), F.coalesce(F.sum(F.when(~full, F.col("share"))), F.lit(0.0)), F.count_if(full)).first()
        higher = (1 - held) / open_ if open_ > 0 else level
        if not n or higher <= level * (1 + 1e-12):
            break
        level = higher
    return values.withColumn("share", F.least(limit, F.lit(level) * F.col("share")))


def rake(cells: DataFrame, margins: list[str], targets: dict[str, dict[str, float]], keep: float = 0.5, fill: float = 0.8, least: float = 0.25, tolerance: float = 5e-3, rounds: int = 60) -> DataFrame:
    """cells (margins, tokens) with ``odds``, by which tokens meet the target marginals. Each step
    is a partial aggregate by one marginal, joined back: no value's cells meet in one task."""
    whole = float(cells.agg(F.sum("tokens")).first()[0] or 1)
    wanted = {m: shares(cells, m, targets.get(m, {})) for m in margins}
    reach = [x.agg(F.min(F.col("n") / F.lit(whole) / F.col("share"))).first()[0] for x in wanted.values()]
    scale = max(float(min(keep, least)), min([float(keep), *(float(fill) * x for x in reach if x is not None)]))
    wanted = {m: within_reach(x, whole * scale, fill) for m, x in wanted.items()}
    w = cells.withColumn("odds", F.lit(scale))
    for m, values in wanted.items():
        w = w.join(values.select(m, (F.col("share") * F.lit(whole * scale)).alias(f"_target_{m}")), m)
    w = spool(w, "cells")
    for _ in range(rounds):
        w = w.withColumn("_off", F.lit(0.0))
        for m in margins:
            gives = w.groupBy(m).agg(F.sum(F.col("tokens") * F.least(F.lit(1.0), "odds")).alias("_sum"))
            factor = F.col(f"_target_{m}") / F.col("_sum")
            w = w.join(gives, m).withColumn("_off", F.greatest("_off", F.abs(1 / factor - 1))).withColumn("odds", F.col("odds") * factor).drop("_sum")
        spooled = spool(w, "raked")
        off = spooled.agg(F.max("_off")).first()[0] or 0.0
        w = spooled.drop("_off")
        if off <= tolerance:
            break
    else:
        warnings.warn(f"raking ended after {rounds} rounds with a marginal {off:.1%} off its target", stacklevel=2)
    return w.select(*margins, "tokens", "odds")


def report(cells: DataFrame, margins: list[str], targets: dict[str, dict[str, float]]) -> DataFrame:
    """(margin, value, target, expected) over cells (margins, tokens, probability): the target
    share of each value and the share of the tokens expected to be drawn."""
    drawn = cells.withColumn("_e", F.col("tokens") * F.col("probability"))
    whole = drawn.agg(F.sum("_e")).first()[0] or 1.0
    out = None
    for m in margins:
        got = drawn.groupBy(m).agg((F.sum("_e") / F.lit(whole)).alias("expected")).join(shares(cells, m, targets.get(m, {})), m)
        part = got.select(F.lit(m).alias("margin"), F.col(m).alias("value"), F.col("share").alias("target"), "expected")
        out = part if out is None else out.unionByName(part)
    return out


def draw(key: Column) -> Column:
    """A number in [0, 1) from an id: 52 bits of its hash."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _margins(docs: DataFrame, text: str) -> dict[str, Column]:
    """Source, language and topic: the documents' own, where they carry a topic."""
    topic = F.col("topic") if "topic" in {c.lower() for c in docs.columns} else topic_of(F.col(text))
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic}


def weights(docs: DataFrame, key: str, text: str, margins: dict[str, Column] | None = None) -> DataFrame:
    """(key, tokens, the margins' values) of every row; texts stay behind."""
    margins = margins or _margins(docs, text)
    values = [F.coalesce(c.cast("string"), F.lit(_NONE)).alias(n) for n, c in margins.items()]
    return docs.select(F.col(key).alias("key"), token_weight(F.col(text)).alias("tokens"), *values)


def odds(light: DataFrame, names: list[str], targets: dict[str, dict[str, float]] | None = None, **how) -> DataFrame:
    """(margins, tokens, probability) of every cell of rows (key, tokens, margins)."""
    cells = spool(light.groupBy(*names).agg(F.sum("tokens").alias("tokens")), "cells")
    fitted = rake(cells, names, TARGETS if targets is None else targets, **how)
    return spool(fitted.select(*names, "tokens", F.least(F.lit(1.0), "odds").alias("probability")), "odds")


def sample(docs: DataFrame, key: str, text: str, margins: dict[str, Column] | None = None, **how) -> DataFrame:
    """The documents drawn, with their columns as they are. The cells are few, but no bound
    holds for every corpus: they are joined by an ordinary join, broadcast by size only."""
    margins = margins or _margins(docs, text)
    names = list(margins)
    table_ = odds(weights(docs, key, text, margins), names, **how)
    inner = free_name(docs, "cell")
    chance = free_name(docs, "probability")
    marked = docs.withColumn(inner, F.struct(*(F.coalesce(c.cast("string"), F.lit(_NONE)).alias(n) for n, c in margins.items())))
    of_cell = table_.select(F.struct(*names).alias(f"{inner}_of"), F.col("probability").alias(chance))
    joined = marked.join(of_cell, F.col(inner) == F.col(f"{inner}_of"))
    return joined.filter(draw(F.col(key)) < F.col(chance)).select(*docs.columns)


def op1_source_mixing(spark, sf_dir: str) -> DataFrame:
    """Every document's tokens, cell, probability, and whether it is drawn."""
    light = spool(weights(table(spark, sf_dir, "documents"), "doc_id", "text"), "weights")
    names = ["source", "lang", "topic"]
    joined = light.join(odds(light, names).drop("tokens"), names)
    return joined.select(F.col("key").alias("doc_id"), *names, "tokens", F.round("probability", 6).alias("probability"), (draw(F.col("key")) < F.col("probability")).alias("sampled"))
