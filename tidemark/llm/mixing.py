"""Mixing sources to target weights, in tokens of a public tokenizer.

Tokens are counted once per document and summed by cell of source, language and topic. Iterative
proportional fitting rakes the cells' token weights to the marginals of source, language and
topic, no cell above what its documents hold times their most repeats; the marginal of source
comes last, so it is met exactly. A cell's weight over its tokens is the number of times its
documents are to be used: the whole part is used as it is, the rest is a document's
probability. Documents are drawn by order sampling: each has a fixed random number over its
probability, and per source those below a threshold are taken. The threshold is found digit by
digit from sums of tokens per source and digit, and the next ``FILL`` documents of a
source may fill what whole documents leave of its tokens; no source's documents are ever sorted
or collected.

The size of the mix is the greatest at which every source's share can be reached under its
most repeats, unless given. Marginals of language and topic are those of all documents of the
sources in the mix, unless given; what contradicts the source marginal gives way to it.

Defined results: documents without a token, of a null source or of a source without a target
are never used; a target without documents stays unreached and doesn't hold the others back; a
null language or topic is a value of its own; a null or negative ``max_repeats`` counts as 0;
empty tables give an empty mix.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Hashable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.tokens import with_token_count
from tidemark.runtime import cut_lineage, require, table

#: Rounds of raking; most cells (sources x languages x topics) that the driver rakes; digits of the threshold.
ROUNDS, MOST_CELLS = 60, 200_000
BITS, DIGITS = 10, 4
#: Documents of a source, next after the threshold, that may fill what is left there.
FILL = 256
Cell = tuple[Hashable, ...]


def _scale(cells: list[Cell], weight: dict[Cell, float], most: dict[Cell, float], want: float) -> None:
    """Scale the cells to ``want`` in sum, none above its most: those that would be are put there, the rest share what is left."""
    free, left = list(cells), want
    while free:
        total = sum(weight[c] for c in free)
        if total <= 0:
            break
        factor = left / total
        over = [c for c in free if weight[c] * factor > most[c]]
        if not over:
            for c in free:
                weight[c] *= factor
            break
        for c in over:
            weight[c] = most[c]
            left -= most[c]
        full = set(over)
        free = [c for c in free if c not in full]
        if left <= 0:
            for c in free:
                weight[c] = 0.0
            break


def rake(tokens: dict[Cell, float], most: dict[Cell, float], marginals: list[dict[Hashable, float]], rounds: int = ROUNDS) -> dict[Cell, float]:
    """Token weights of cells, whose k-th key has the sums ``marginals[k]``; the first marginal is fitted last and holds exactly where it can."""
    weight = {c: min(float(t), most[c]) for c, t in tokens.items()}
    groups: list[dict[Hashable, list[Cell]]] = [defaultdict(list) for _ in marginals]
    for c in weight:
        for k, key in enumerate(c):
            groups[k][key].append(c)
    for _ in range(rounds):
        for k in [*range(1, len(marginals)), 0]:
            for key, cells in groups[k].items():
                if key in marginals[k]:
                    _scale(cells, weight, most, marginals[k][key])
    return weight


def _threshold(rows: DataFrame, need: DataFrame) -> DataFrame:
    """source, cut, room: documents of a source whose ``r`` is below cut are within ``need`` tokens and leave ``room`` of them; the one at the cut would go beyond."""
    left = rows
    goal = need.select("source", F.col("need").cast("double").alias("room"), F.lit(0).cast("long").alias("cut"))
    width = BITS * DIGITS
    for at in range(DIGITS):
        shift = width - BITS * (at + 1)
        digit = F.shiftright("r", shift).bitwiseAND(F.lit((1 << BITS) - 1))
        sums = left.groupBy("source", digit.alias("digit")).agg(F.sum("n_tokens").alias("n"))
        # at most 1024 rows to a source
        sums = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("source").orderBy("digit")))
        step = sums.join(goal, "source").where("upto > room and upto - n <= room")
        step = step.select("source", (F.col("room") - F.col("upto") + F.col("n")).alias("room"), F.col("n"), F.col("cut").bitwiseOR(F.shiftleft(F.col("digit").cast("long"), shift)).alias("cut"), "digit")
        step = cut_lineage(step)
        goal = step.select("source", "room", "cut")
        if at == DIGITS - 1:
            return step.select("source", "cut", "room")
        left = cut_lineage(left.join(step.select("source", F.col("digit").alias("_d")), "source").where(digit == F.col("_d")).drop("_d"))
    raise AssertionError


def _fillers(uses: DataFrame, cut: DataFrame, ident: str) -> DataFrame:
    """doc_id of the documents from the cut on that, in order of r, still fit into the room, until none does.

    In turn the next FILL that fit are tried one by one, and of the rest all below a new threshold come in.
    """
    spark = uses.sparkSession
    left = uses.join(cut, "source").where("r >= cut and n_tokens <= room").select("doc_id", "source", "n_tokens", "r", "room")
    found = spark.createDataFrame([], ident)
    while True:
        next_up = left.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy("r", "doc_id"))).where(F.col("k") <= FILL)
        extra, room_left, last = [], {}, {}
        for row in next_up.orderBy("source", "k").select("source", "doc_id", "n_tokens", "room", "k").collect():  # at most FILL for each target
            gap = room_left.setdefault(row["source"], row["room"])
            last[row["source"]] = row["k"]
            if row["n_tokens"] <= gap:
                extra.append((row["doc_id"],))
                room_left[row["source"]] = gap - row["n_tokens"]
        some = spark.createDataFrame(extra, ident)
        found = found.unionByName(some)
        rooms = [(s, room) for s, room in room_left.items() if last[s] == FILL]
        if not rooms:
            return found
        goal = F.broadcast(spark.createDataFrame(rooms, "source string, need double"))  # one row a target
        left = left.drop("room").join(goal, "source").where("n_tokens <= need").join(F.broadcast(some), "doc_id", "left_anti")  # at most FILL for each target
        left = cut_lineage(left)
        if left.isEmpty():
            return found
        at = _threshold(left.select("source", "n_tokens", "r"), left.select("source", "need").distinct())
        left = cut_lineage(left.drop("need").join(at, "source", "left"))
        # where there is no cut all that is left fits
        found = found.unionByName(left.where("cut is null or r < cut").select("doc_id"))
        left = left.where("r >= cut and n_tokens <= room").select("doc_id", "source", "n_tokens", "r", "room")


def mix(docs: DataFrame, targets: DataFrame, total_tokens: float | None = None, languages: dict[str | None, float] | None = None, topics: dict[str | None, float] | None = None, seed: int = 17) -> DataFrame:
    """doc_id, source, lang, topic, n_tokens, repeats of each document used. ``docs`` has doc_id, source, lang, topic, n_tokens; ``targets`` source, target_share, max_repeats."""
    require(docs, "doc_id", "source", "lang", "topic", "n_tokens")
    require(targets, "source", "target_share", "max_repeats")
    spark = docs.sparkSession
    asked = {r["source"]: (max(r["target_share"] or 0.0, 0.0), max(r["max_repeats"] or 0, 0)) for r in targets.where("source is not null").limit(MOST_CELLS + 1).toLocalIterator()}
    docs = docs.where("source is not null and n_tokens > 0").join(targets.select("source").where("target_share > 0 and max_repeats > 0").distinct(), "source", "left_semi")
    docs = cut_lineage(docs.select("doc_id", "source", "lang", "topic", "n_tokens"))
    held = docs.groupBy("source", "lang", "topic").agg(F.sum("n_tokens").alias("n")).limit(MOST_CELLS + 1).collect()
    if len(held) > MOST_CELLS or len(asked) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} cells or targets: languages and topics must be codes, not free text")
    out = "doc_id {}, source string, lang string, topic string, n_tokens long, repeats int".format(docs.schema["doc_id"].dataType.simpleString())
    if not held:
        return spark.createDataFrame([], out)
    tokens = {(r["source"], r["lang"], r["topic"]): float(r["n"]) for r in held}
    most = {c: n * asked[c[0]][1] for c, n in tokens.items()}
    room: dict[Hashable, float] = defaultdict(float)
    for c, n in most.items():
        room[c[0]] += n
    size = min(room[s] / asked[s][0] for s in room) if total_tokens is None else total_tokens
    whole = sum(tokens.values())
    marginals: list[dict[Hashable, float]] = [{s: min(asked[s][0] * size, room[s]) for s in room}]
    aim = sum(marginals[0].values())
    for k, given in ((1, languages), (2, topics)):
        own: dict[Hashable, float] = defaultdict(float)
        for c, n in tokens.items():
            own[c[k]] += n / whole
        marginals.append({x: aim * share for x, share in (given or own).items()})
    weight = rake(tokens, most, marginals)
    cells = spark.createDataFrame([(*c, weight[c] / n) for c, n in tokens.items()], "source string, lang string, topic string, uses double")
    uses = docs.alias("d").join(F.broadcast(cells).alias("c"), F.expr("d.source = c.source and d.lang <=> c.lang and d.topic <=> c.topic"))  # at most MOST_CELLS rows, checked above
    uses = uses.select("d.doc_id", "d.source", "d.lang", "d.topic", "d.n_tokens", F.floor(F.col("uses") + 1e-9).cast("int").alias("base"), "uses")
    share = F.greatest(F.col("uses") - F.col("base"), F.lit(0.0))
    # a fixed random number over the probability; 1 on the scale of r is 2 ** 34, so that r stays within its digits up to 64 times the probability
    unit = (F.xxhash64(F.lit(seed), "doc_id").bitwiseAND(F.lit((1 << 52) - 1)) + F.lit(0.5)) / F.lit(float(1 << 52))
    top = (1 << BITS * DIGITS) - 1
    r = F.least(F.floor(unit / share * F.lit(float(1 << 34))), F.lit(top)).cast("long")
    uses = cut_lineage(uses.withColumn("r", F.when(share > 1e-9, r)).drop("uses"))
    used = {r["source"]: r["n"] or 0 for r in uses.groupBy("source").agg(F.sum(F.col("base") * F.col("n_tokens")).alias("n")).collect()}
    need = spark.createDataFrame([(s, marginals[0][s] - used.get(s, 0)) for s in room], "source string, need double").where("need > 0")
    short = need.select("source", F.lit(True).alias("_short"))
    cut = cut_lineage(_threshold(uses.where("r is not null").select("source", "n_tokens", "r"), need))
    full = uses.join(cut.drop("room"), "source", "left").join(short, "source", "left")
    # no cutoff although tokens are wanting: all documents with a probability come in
    taken = F.col("r").isNotNull() & F.col("_short").isNotNull() & (F.col("cut").isNull() | (F.col("r") < F.col("cut")))
    # the document at the threshold may be far larger than what is wanting there: the next ones that fit fill the gap
    added = _fillers(uses, cut, out.split(",")[0])
    full = full.join(added.withColumn("_more", F.lit(1)), "doc_id", "left")
    more = F.when(taken, 1).otherwise(F.coalesce("_more", F.lit(0)))
    return full.select("doc_id", "source", "lang", "topic", "n_tokens", (F.col("base") + more).cast("int").alias("repeats")).where("repeats > 0")


def reached(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_share, reached_share, tokens, documents, most_repeats, missing_tokens of each target; what is missing is so of the tokens that the whole mix has."""
    return _held(mixed, targets.select(F.col("source").alias("value"), "target_share"), "source").withColumnRenamed("value", "source")


def _held(mixed: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    got = mixed.groupBy(F.col(column).alias("value")).agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("repeats").alias("most_repeats"))
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))  # one row a target
    full = wanted.alias("w").join(got.alias("g"), F.expr("w.value <=> g.value"), "left").select("w.value", "target_share", "tokens", "documents", "most_repeats").withColumn("all_tokens", total)
    zero = lambda c: F.coalesce(c, F.lit(0))
    missing = F.greatest(F.ceil(F.col("target_share") * F.col("all_tokens") - zero("tokens")), F.lit(0)).cast("long")
    return full.select(
        "value", "target_share", F.round(zero("tokens") / F.col("all_tokens"), 6).alias("reached_share"), zero("tokens").alias("tokens"), zero("documents").alias("documents"), zero("most_repeats").alias("most_repeats"), zero(missing).alias("missing_tokens"),
    )


def reached_marginals(mixed: DataFrame, docs: DataFrame, targets: DataFrame) -> DataFrame:
    """kind (source, lang or topic), value and the columns of ``reached``; languages and topics are wanted as the sources' documents have them."""
    parts = [_held(mixed, targets.select(F.col("source").alias("value"), "target_share"), "source").select(F.lit("source").alias("kind"), "*")]
    held = docs.where("n_tokens > 0").join(targets.where("target_share > 0 and max_repeats > 0").select("source").distinct(), "source", "left_semi")
    for column in ("lang", "topic"):
        own = held.groupBy(F.col(column).alias("value")).agg(F.sum("n_tokens").alias("n"))
        own = own.select("value", (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1)))).alias("target_share"))  # one row a code
        parts.append(_held(mixed, own, column).select(F.lit(column).alias("kind"), "*"))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _counted(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    targets = table(spark, sf_dir, "mix_targets")
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.col("layer").alias("topic"), "text").join(targets.select("source"), "source", "left_semi")
    return cut_lineage(with_token_count(docs, keep=["doc_id", "source", "lang", "topic"])), targets


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(*_counted(spark, sf_dir)).select("doc_id", "source", "n_tokens", "repeats")


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shares of sources, languages and topics, wanted and reached, and the tokens missing."""
    docs, targets = _counted(spark, sf_dir)
    return reached_marginals(mix(docs, targets), docs, targets)


QUERIES = {"p9_mix": p9_mix, "p9_shares": p9_shares}
SQL: dict[str, str] = {}
