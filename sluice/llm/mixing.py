"""Mix sources to target weights: exact block quotas dealt to output shards by a splitting tree.

Each source is a stream of its documents in hash order, cut into blocks of equal word counts. A source's target
fixes how many of its blocks are drawn (whole rounds first, then a permuted part, the last block trimmed so that
the target is met to the word). The quotas of all sources are then split among the output shards: a node of the
tree deals its left half a multivariate hypergeometric sample of its blocks, source by source, by inverting the
exact distribution function at a hashed uniform number. A shard draws its share as consecutive places of the source's
permuted block order, so shards are disjoint, and orders what it drew by a hash of its own.

All of it is DataFrame work; what is kept per source or shard is one row of numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sluice.llm.common import ROW, WORD, held, let, sized, written

#: Of each three sources in order, their weights.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
_BUCKET_ROWS = 20_000
_TAIL = 12
_STRETCH = 1024


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, repeats: int = MOST_REPEATS) -> DataFrame:
    """Per source of ``sizes`` (source, size): ``rank``, ``source_size`` and ``target`` in words.

    Sources by code point, null last, take the weights in turn and share ``share`` times all words; a target stops at
    ``repeats`` times the source's size and what is above goes to the others by weight, until none is above.
    In order of size per weight the capped sources come first, so the level of the rest is found in one pass.
    """
    one = Window.partitionBy(F.lit(0))
    by_name = one.orderBy(F.col("source").cast("binary").asc_nulls_last())
    by_room = one.orderBy("room", "rank")
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    rest = by_room.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))  # one small row per source from here on
    ranked = per_source.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    )
    level = ranked.withColumns(
        {"cap": F.col("source_size") * repeats, "room": F.col("source_size") * repeats / F.col("weight")}
    ).withColumn(
        "level",
        (F.sum("source_size").over(one) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        / F.sum("weight").over(rest),
    )
    open_ = F.min(F.when(F.col("room") >= F.col("level"), F.struct("room", "rank", "level"))).over(one)
    return level.withColumn("at", open_.getField("level")).select(
        "source",
        "rank",
        "source_size",
        F.coalesce(F.least(F.col("cap").cast("double"), F.col("at") * F.col("weight")), F.col("cap").cast("double")).alias("target"),
    )


def _log_factorial(k: Column) -> Column:
    z = k + 8.0
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z)
    product = k + 1.0
    for j in range(2, 8):
        product = product * (k + float(j))
    return series - F.log(product)


def hypergeometric(good: Column, total: Column, draws: Column, uniform: Column) -> Column:
    """How many of ``draws`` items, drawn without return from ``total``, are among the ``good``: the inverse of the
    distribution function at ``uniform``. Beyond 12 standard deviations the probability is below double precision."""
    low = F.greatest(F.lit(0), draws - (total - good))
    high = F.least(draws, good)
    mode = F.floor((draws + 1.0) * (good + 1.0) / (total + 2.0)).cast("long")
    share = good / F.greatest(total, F.lit(1))
    deviation = F.sqrt(draws * share * (1 - share) * (total - draws) / F.greatest(total - 1, F.lit(1)))
    reach = F.ceil(deviation * _TAIL).cast("long") + 12
    weight = lambda k: F.exp(
        _log_factorial(mode) + _log_factorial(good - mode) + _log_factorial(draws - mode) + _log_factorial(total - good - draws + mode)
        - _log_factorial(k) - _log_factorial(good - k) - _log_factorial(draws - k) - _log_factorial(total - good - draws + k)
    )
    span = F.sequence(F.greatest(low, mode - reach), F.least(high, mode + reach))
    weighed = F.transform(span, lambda k: F.struct(k.alias("k"), weight(k).alias("w")))

    def pick(items: Column) -> Column:
        limit = uniform * F.aggregate(items, F.lit(0.0), lambda s, x: s + x["w"])
        start = F.struct(F.lit(0.0).alias("s"), F.lit(-1).cast("long").alias("k"))
        step = lambda a, x: F.struct(
            (a["s"] + x["w"]).alias("s"), F.when(a["s"] <= limit, x["k"]).otherwise(a["k"]).alias("k")
        )
        return F.aggregate(items, start, step)["k"]

    return F.when(low >= high, low).otherwise(let(weighed, pick))


def _uniform(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / float(1 << 52)


def split_quotas(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """Deal ``quotas`` (rank, quota; one row per source) to ``shards``: rows (rank, shard, first, quota), none empty.

    Shards get equal block counts up to one. ``first`` is where a shard's blocks begin in the source's draw order.
    """
    node = "lo int, hi int, left array<bigint>"
    root = quotas.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "quota"))), lambda x: x["quota"]).alias("left")
    ).select(F.lit(0).alias("lo"), F.lit(shards).alias("hi"), F.coalesce("left", F.array().cast("array<bigint>")).alias("left"))
    total = lambda q: F.aggregate(q, F.lit(0).cast("long"), lambda s, x: s + x)

    def dealt(q: Column, draws: Column, lo: Column, hi: Column) -> Column:
        start = F.struct(
            draws.cast("long").alias("draws"), total(q).alias("rest"), F.lit(0).alias("i"), F.array().cast("array<bigint>").alias("got")
        )

        def step(a: Column, x: Column) -> Column:
            u = _uniform(F.lit(seed), lo, hi, a["i"])
            return let(
                hypergeometric(x, a["rest"], a["draws"], u),
                lambda k: F.struct(
                    (a["draws"] - k).alias("draws"), (a["rest"] - x).alias("rest"), (a["i"] + 1).alias("i"),
                    F.concat(a["got"], F.array(k)).alias("got"),
                ),
            )

        return F.aggregate(q, start, step)["got"]

    nodes = written(root, "mix-root")
    blocks = nodes.select(total(F.col("left"))).first()[0]
    for _ in range(math.ceil(math.log2(shards)) if shards > 1 else 0):
        mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        share = lambda at: F.floor(F.lit(blocks) * at.cast("long") / F.lit(shards)).cast("long")
        split = nodes.withColumn(
            "got", dealt(F.col("left"), share(mid) - share(F.col("lo")), F.col("lo"), F.col("hi"))
        )
        halves = F.array(
            F.struct(F.col("lo"), mid.alias("hi"), F.col("got").alias("left")),
            F.struct(mid.alias("lo"), F.col("hi"), F.zip_with("left", "got", lambda a, b: a - b).alias("left")),
        )
        whole = F.array(F.struct("lo", "hi", "left"))
        children = F.when(F.col("hi") - F.col("lo") > 1, halves.cast(f"array<struct<{node.replace(' ', ':')}>>".replace(",:", ","))).otherwise(
            whole.cast(f"array<struct<{node.replace(' ', ':')}>>".replace(",:", ","))
        )
        nodes = written(split.select(F.inline(children)), "mix-level")
    leaves = nodes.select(F.col("lo").alias("shard"), F.posexplode("left").alias("rank", "quota")).filter("quota > 0")
    order = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaves.withColumn("first", F.coalesce(F.sum("quota").over(order), F.lit(0)))


def _placed(meta: DataFrame, seed: int) -> DataFrame:
    """``meta`` (doc_id, source, size) with ``start``: the words before it in its source's stream, in hash order.

    A source is cut into hash buckets of some thousand rows; offsets of buckets come from their sums, so no task
    holds a whole source.
    """
    rows = meta.count()
    buckets = 1 << max(0, math.ceil(math.log2(max(1, rows / _BUCKET_ROWS))))
    hashed = meta.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id", "size")).withColumn("_b", F.pmod("_h", F.lit(buckets)))
    in_source = Window.partitionBy("source").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        hashed.groupBy("source", "_b").agg(F.sum("size").alias("_sum")).withColumn("_before", F.coalesce(F.sum("_sum").over(in_source), F.lit(0)))
    ).select(F.col("source").alias("_source"), F.col("_b").alias("_bucket"), "_before")
    within = Window.partitionBy("source", "_b").orderBy("_h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    running = hashed.withColumn("_run", F.coalesce(F.sum("size").over(within), F.lit(0)))
    joined = running.join(
        offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_b") == F.col("_bucket")), "left"
    )
    return joined.withColumn("start", F.col("_before") + F.col("_run")).drop("_h", "_b", "_run", "_before", "_source", "_bucket")


def _stride(n: Column, seed: int) -> Column:
    """A number without common divisor with ``n``: the first prime of a list, from a hashed place on, that does not divide it."""
    primes = F.array(*map(F.lit, (1_000_003, 1_000_033, 1_000_037, 1_000_039, 1_000_081, 1_000_099, 1_000_117, 1_000_121)))
    fit = F.filter(primes, lambda p: n % p != 0)
    return F.element_at(fit, (F.pmod(F.xxhash64(F.lit(seed), n), F.size(fit)) + 1).cast("int")).cast("long")


def draw(
    docs: DataFrame,
    block_words: int = 4096,
    shard_words: int = 4 << 20,
    seed: int = 17,
    weights=WEIGHTS,
    share: float = SHARE,
    repeats: int = MOST_REPEATS,
) -> DataFrame:
    """Pieces drawn from ``docs`` (doc_id, text, source): one row per document and block, one without a piece for others.

    Columns: doc_id, source, size, start (the document's place in its source), source_size, target; for a piece also
    round, block, words, shard and place (its hash order within the shard). A null text has size 0; a null source is a
    source of its own; ids may be null or repeat. The rows depend on ids, sizes and sources alone.
    """
    meta = written(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), word_count().alias("size")
        ),
        "mix-sizes",
    )
    plan = targets(meta.select("source", "size"), weights, share, repeats)
    aim = F.floor(F.col("target") + 0.5).cast("long")
    full = F.floor(F.col("aim") / F.greatest(F.col("source_size"), F.lit(1))).cast("long")
    n = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")
    plan = plan.withColumn("aim", aim).withColumns({"rounds": full, "blocks": n})
    plan = plan.withColumns(
        {
            "part": F.col("aim") - F.col("rounds") * F.col("source_size"),
            "step": _stride(F.col("blocks"), seed),
            "turn": F.pmod(F.xxhash64(F.lit(seed), "rank"), F.col("blocks")),
        }
    )
    place = lambda block: F.pmod(block * F.pmod("step", "blocks") + F.col("turn"), F.col("blocks"))
    plan = plan.withColumns(
        {
            "last_place": place(F.col("blocks") - 1),
            "short": F.col("blocks") * block_words - F.col("source_size"),  # what the last block lacks
        }
    )
    before = lambda p: p * block_words - F.when(F.col("last_place") < p, F.col("short")).otherwise(0)
    cut = F.ceil(F.col("part") / block_words).cast("long")
    drawn = F.when(before(cut) < F.col("part"), cut + 1).otherwise(cut)
    plan = plan.withColumn("quota", F.col("rounds") * F.col("blocks") + F.least(drawn, F.col("blocks")))
    plan = written(plan, "mix-plan")
    words = plan.agg(F.sum("aim")).first()[0] or 0
    dealt = split_quotas(plan.select("rank", "quota"), max(1, math.ceil(words / shard_words)), seed)

    at = plan.select(
        F.col("source").alias("_source"), "rank", "source_size", "target", "rounds", "blocks", "part", "step", "turn", "last_place", "short"
    )
    own = _placed(meta, seed).join(at, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    first, last = F.floor(F.col("start") / block_words), F.floor((F.col("start") + F.col("size") - 1) / block_words)
    spans = F.when(F.col("size") > 0, F.sequence(first.cast("long"), last.cast("long")))
    own = own.withColumn("block", F.explode_outer(spans))
    own = own.withColumns(
        {
            "_from": F.greatest(F.col("start"), F.col("block") * block_words) - F.col("block") * block_words,
            "_to": F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.col("block") * block_words,
            "_place": place(F.col("block")),
        }
    )
    own = own.withColumn("_room", F.col("part") - before(F.col("_place")))  # words of this block's place that the part still takes
    own = own.withColumn("round", F.explode_outer(F.when(F.col("block").isNotNull(), F.sequence(F.lit(0), F.col("rounds").cast("int")))))
    piece = F.when(F.col("round") < F.col("rounds"), F.col("_to") - F.col("_from")).otherwise(
        F.greatest(F.lit(0), F.least(F.col("_to"), F.col("_room")) - F.col("_from"))
    )
    own = own.withColumn("words", F.when(F.col("round").isNotNull(), piece)).withColumn(
        "_draw", F.when(F.col("words") > 0, F.col("round") * F.col("blocks") + F.col("_place"))
    )
    # A shard's run of places covers whole cells of places; a piece meets it by cell.
    cell = max(1, shard_words // block_words)
    runs = dealt.select(
        F.col("rank").alias("_rank"),
        "shard",
        "first",
        (F.col("first") + F.col("quota")).alias("end"),
        F.explode(F.sequence(F.floor(F.col("first") / cell), F.floor((F.col("first") + F.col("quota") - 1) / cell))).alias("_cell"),
    )
    meets = (
        (F.col("rank") == F.col("_rank"))
        & (F.floor(F.col("_draw") / cell) == F.col("_cell"))
        & (F.col("_draw") >= F.col("first"))
        & (F.col("_draw") < F.col("end"))
    )
    kept = ["doc_id", "source", "size", "start", "source_size", "target", "round", "block", "words", "shard"]
    return (
        own.join(runs, meets, "left")
        .select(*kept)
        .withColumn("place", F.when(F.col("shard").isNotNull(), F.xxhash64(F.lit(seed), "shard", "source", "round", "block", "start")))
    )


def taken(pieces: DataFrame) -> DataFrame:
    """One row per document of ``draw``: doc_id, size, source_size, target, taken (words, repeats counted), shards."""
    some = pieces.filter("size > 0").groupBy("doc_id", "source", "start", "size", "source_size", "target")
    rows = some.agg(
        F.coalesce(F.sum(F.when(F.col("shard").isNotNull(), F.col("words"))), F.lit(0)).alias("taken"),
        F.array_sort(F.collect_set("shard")).alias("shards"),
    ).select("doc_id", "size", "source_size", "target", "taken", "shards")
    none = pieces.filter("size = 0").select(
        "doc_id", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), F.array().cast("array<int>").alias("shards")
    )
    return rows.unionByName(none)


def _copies(pieces: DataFrame, block_words: int) -> DataFrame:
    """(doc_id, source, start, size, copies) of ``draw``'s rows with words.

    A document of one block at most comes as often as its taken words fill it, rounded, which is right on average. Of a longer
    one the taken share is near its source's, so all would be rounded alike: these are rounded down or up in the source's
    order, by the words that are owed so far. Stretches of the order start anew, so that no task holds a source.
    """
    rows = pieces.filter("size > 0").groupBy("doc_id", "source", "start", "size").agg(
        F.coalesce(F.sum(F.when(F.col("shard").isNotNull(), F.col("words"))), F.lit(0)).cast("long").alias("taken")
    )
    rows = written(rows, "mix-taken")
    short = rows.filter(F.col("size") <= block_words).withColumn("copies", F.floor(F.col("taken") / F.col("size") + 0.5).cast("int"))
    out = "array<struct<doc_id:bigint,start:bigint,size:bigint,copies:int>>"

    def step(a: Column, x: Column) -> Column:
        whole = F.floor(x["taken"] / x["size"]).cast("long")
        low = F.floor((a["owed"] + x["taken"]) / x["size"] + 0.5).cast("long")
        most = F.when(x["taken"] > whole * x["size"], whole + 1).otherwise(whole)
        return let(
            F.least(F.greatest(low, whole), most),
            lambda n: F.struct(
                (a["owed"] + x["taken"] - n * x["size"]).alias("owed"),
                F.concat(a["out"], F.array(F.struct(x["doc_id"].alias("doc_id"), x["start"].alias("start"), x["size"].alias("size"), n.cast("int").alias("copies"))).cast(out)).alias("out"),
            ),
        )

    start = F.struct(F.lit(0).cast("long").alias("owed"), F.array().cast(out).alias("out"))
    long = (
        rows.filter(F.col("size") > block_words)
        .groupBy("source", F.floor(F.col("start") / (block_words * _STRETCH)).alias("stretch"))
        .agg(F.array_sort(F.collect_list(F.struct("start", "size", "doc_id", "taken"))).alias("rows"))  # _STRETCH at most
        .select("source", F.inline(F.aggregate("rows", start, step)["out"]))
    )
    kept = ["doc_id", "source", "start", "size", "copies"]
    return short.select(*kept).unionByName(long.select(*kept))


def mixed(docs: DataFrame, block_words: int = 4096, **options) -> DataFrame:
    """``docs`` as whole documents, as often as ``_copies`` says. Ids may be null or repeat: rows of one id, source and size
    share out their copies among them; texts without words are not drawn. All columns stay as they are, whatever their names; an
    empty table gives no rows."""
    copies = _copies(draw(docs, block_words, **options), block_words)
    keys = ["_id", "_source", "_size"]
    named = copies.select(F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"), "start", "copies")
    per_key = named.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("start", "copies"))), lambda x: x["copies"]).alias("_copies"))
    per_key = written(per_key.filter(F.exists("_copies", lambda n: n > 0)), "mix-copies")
    text = F.xxhash64(F.col("text").cast("string"))
    own = held(docs, _d=F.col("doc_id").cast("long"), _s=F.col("source").cast("string"), _n=word_count(), _text=text)
    same = F.col("_d").eqNullSafe(F.col("_id")) & F.col("_s").eqNullSafe(F.col("_source")) & (F.col("_n") == F.col("_size"))
    one = own.join(sized(per_key.filter(F.size("_copies") == 1)), same).withColumn("_nth", F.lit(1))
    some = own.join(sized(per_key.filter(F.size("_copies") > 1)), same)
    some = some.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy("_text")))
    kept = one.unionByName(some).withColumn("_times", F.coalesce(F.get("_copies", F.col("_nth") - 1), F.lit(0))).filter("_times > 0")
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(f"{ROW}.*")
