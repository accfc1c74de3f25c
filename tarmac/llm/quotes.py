"""Quotation linking in conversations.

Lines that begin with ``>`` marks are quotes, as deep as there are marks. Adjacent
lines of one level are a passage. It is normalised across its line ends (lower case,
letters and digits only, one space between words), so that a quote wrapped anew by a
mail program stays the same passage, and hashed by its windows of ``WINDOW`` words; a
shorter passage is one window. Each window is linked to the latest earlier message of
its conversation that says it in its own words, a passage to the message that most of
its windows lead to. A message replies to the one that most windows of its found
passages of the least level lead to, as deeper quotes are of older messages; the later
message goes first if two are equal. A message that quotes nothing found replies to the
message before it.

Only hashes travel, but for own text in conversations that quote, which is spread by
``SALTS``. Own windows are taken of the sizes that the conversation's quotes have, and
those that nobody quotes are dropped by a join on both. Carried values are computed per
stretch of ``STRETCH`` turns and then over stretches, so that a conversation with a
third of all messages is spread over tasks.

Defined results: a null text is empty, has no quotes and stays null. A message without
conversation or turn is returned, linked with nothing. Repeated rows and messages of
one turn are linked alike, never with each other. A quote without letters or digits
counts for nothing. A text of any length is taken whole, in time linear in it. An empty
table gives none; further columns of whatever name stay in ``row``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm import common
from tarmac.llm.common import keep

STRETCH = 1000
#: Words of a window; shorter passages are hashed whole.
WINDOW = 5
#: Parts into which the own texts of a conversation are spread.
SALTS = 16

_MARKS = r"^[ \t]*((?:>[ \t]?)+)"
#: The line by which mail programs announce a quote.
_ANNOUNCED = r"(?i)^[^>].{0,200}\b(wrote|writes|schrieb|a écrit|escribió)\s*:\s*$"


def normalised(line: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " "))


def parsed(messages: DataFrame) -> DataFrame:
    """``row``, ``conv_id``, ``turn`` and ``lines``: level, text and normalised text of each line."""
    df = messages.select(
        F.struct(*(messages[common.quoted(c)] for c in messages.columns)).alias("row"),
        F.col("conv_id").cast("bigint"),
        F.col("turn").cast("bigint"),
    )

    def line(x: Column) -> Column:
        body = F.regexp_replace(x, _MARKS, "")
        marks = F.regexp_extract(x, _MARKS, 1)
        level = F.length(F.regexp_replace(marks, "[^>]", ""))
        level = F.when(x.rlike(_ANNOUNCED), -1).otherwise(level)
        return F.struct(level.alias("level"), body.alias("text"), normalised(body).alias("words"))

    lines = F.transform(F.split(F.coalesce(F.col("row.text"), F.lit("")), "\r?\n"), line)
    return df.withColumn("lines", lines)


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``value`` as a column that expressions on each of its elements do not compute again."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def passages(df: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``level`` and ``words`` (an array) of each run of lines of one level."""
    df = df.select("conv_id", "turn", "lines").filter("conv_id IS NOT NULL AND turn IS NOT NULL")
    df = _once(df, "all", F.col("lines")).drop("lines")
    level = lambda i: F.get("all", i)["level"]
    places = F.sequence(F.lit(0), F.size("all") - 1)
    df = _once(df, "starts", F.filter(places, lambda i: (i == 0) | (level(i) != level(i - 1))))

    def run(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get("starts", k + 1), F.size("all"))
        said = F.filter(F.transform(F.sequence(start, end - 1), lambda i: F.get("all", i)["words"]), lambda x: x != "")
        return F.struct(level(start).alias("level"), F.array_join(said, " ").alias("words"))

    df = df.select("conv_id", "turn", F.explode(F.transform("starts", run)).alias("run"))
    df = df.select("conv_id", "turn", "run.level", "run.words").filter("words != ''")
    return _once(df, "word", F.split("words", " ")).select("conv_id", "turn", "level", F.col("word").alias("words"))


def _windows(size: Column) -> Column:
    """The hashes of all windows of ``words`` of that size."""
    # ``slice`` within a lambda goes through the whole array, ``get`` does not.
    word = lambda i, k: F.when(F.lit(k) < size, F.get("words", i + k))
    window = lambda i: F.concat_ws(" ", *(word(i, k) for k in range(WINDOW)))
    places = F.sequence(F.lit(0), F.size("words") - size)
    return F.array_distinct(F.transform(places, lambda i: F.xxhash64(window(i))))


def _quoted(runs: DataFrame) -> DataFrame:
    """``hash`` and ``size`` of each window of each quoted ``passage``, which stands ``n`` times in its turn."""
    df = runs.filter("level > 0").withColumn("size", F.least(F.size("words"), F.lit(WINDOW)))
    # In a step of its own: beside the ``explode`` it would be computed for each window.
    df = df.withColumn("passage", F.xxhash64(F.array_join("words", " ")))
    df = df.select("conv_id", "turn", "level", "passage", "size", F.explode(_windows(F.col("size"))).alias("hash"))
    return df.groupBy("conv_id", "turn", "level", "passage", "size", "hash").agg(F.count("*").alias("n"))


def _said(runs: DataFrame, quoted: DataFrame) -> DataFrame:
    """``conv_id``, ``hash`` and ``turn`` of the own windows that the conversation quotes somewhere."""
    sizes = quoted.groupBy("conv_id").agg(F.collect_set("size").alias("sizes"))
    sizes = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = runs.filter("level = 0").withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(SALTS)).cast("int"))
    own = own.join(sizes, ["conv_id", "salt"]).select("conv_id", "turn", "words", F.explode("sizes").alias("size"))
    own = own.filter(F.size("words") >= F.col("size"))
    own = own.select("conv_id", "turn", F.explode(_windows(F.col("size"))).alias("hash")).distinct()
    return own.join(quoted.select("conv_id", "hash").distinct(), ["conv_id", "hash"], "left_semi")


def _last_before(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``before``: the last non-null ``value`` at an earlier turn of the same keys."""
    df = keep(df.withColumn("stretch", F.floor(F.col("turn") / STRETCH)))
    ends = df.filter(F.col(value).isNotNull()).groupBy(*keys, "stretch").agg(F.max(value).alias("end"))
    # Every stretch with rows needs what the stretches before it ended with.
    ends = df.select(*keys, "stretch").distinct().join(ends, [*keys, "stretch"], "left")
    over = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*keys, "stretch", F.max("end").over(over).alias("carried"))
    own = Window.partitionBy(*keys, "stretch").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("own", F.max(value).over(own)).join(keep(ends), [*keys, "stretch"])
    return df.withColumn("before", F.coalesce("own", "carried")).drop("own", "carried", "stretch")


def links(df: DataFrame) -> DataFrame:
    """Per message (``conv_id``, ``turn``) the message it quotes, and how many passages were quoted and found."""
    runs = passages(df)
    quoted = keep(_quoted(runs))
    both = quoted.select("conv_id", "hash", "turn", F.lit(None).cast("bigint").alias("said"), "level", "passage", "n")
    said = _said(runs, quoted).withColumn("said", F.col("turn"))
    both = both.unionByName(said, allowMissingColumns=True)
    found = _last_before(both, ["conv_id", "hash"], "said").filter("said IS NULL")
    passage = ["conv_id", "turn", "level", "passage"]
    per = found.groupBy(*passage, "before").agg(F.count("*").alias("windows"), F.max("n").alias("n"))
    known = F.col("before").isNotNull()
    per = per.groupBy(*passage).agg(
        F.max(F.when(known, F.struct("windows", "before"))).alias("most"),
        F.max("n").alias("n"),
    )
    per = per.groupBy("conv_id", "turn", "level", F.col("most.before").alias("before")).agg(
        F.sum(F.col("most.windows") * F.col("n")).alias("windows"),
        F.sum("n").alias("n"),
    )
    nearest = F.max(F.when(known, F.struct(-F.col("level"), "windows", "before")))["before"]
    return per.groupBy("conv_id", "turn").agg(
        nearest.alias("quotes_turn"),
        F.sum("n").alias("n_quoted"),
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("n_linked"),
        F.max("level").alias("quote_depth"),
    )


def link_quotations(messages: DataFrame) -> DataFrame:
    """``row``, the text without quotes, what the message replies to and its place in the reply order.

    ``reply_to`` is a turn. ``branch`` is the turn at which the message's run of replies
    to the message before begins, and ``branch_of`` the turn that run replies to:
    ordered by ``conv_id, branch_of, branch, turn``, each run follows what it answers.
    """
    df = parsed(messages)
    turns = df.filter("conv_id IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn").distinct()
    turns = _last_before(turns.withColumn("own_turn", F.col("turn")), ["conv_id"], "own_turn")
    turns = turns.select("conv_id", "turn", F.col("before").alias("previous"))
    linked = turns.join(keep(links(df)), ["conv_id", "turn"], "left")
    linked = linked.withColumn("reply_to", F.coalesce("quotes_turn", "previous"))
    opens = F.col("reply_to").isNull() | (F.col("reply_to") != F.col("previous"))
    linked = keep(linked.withColumn("opened", F.when(opens, F.col("turn"))))
    branches = _last_before(linked.select("conv_id", "turn", "opened"), ["conv_id"], "opened")
    branches = branches.select("conv_id", "turn", F.coalesce("opened", "before").alias("branch"))
    linked = linked.join(keep(branches), ["conv_id", "turn"])
    openers = linked.filter("opened IS NOT NULL").select("conv_id", F.col("turn").alias("branch"), F.col("reply_to").alias("branch_of"))
    linked = keep(linked.join(keep(openers), ["conv_id", "branch"]))
    linked = linked.select(
        *("conv_id", "turn", "reply_to", "branch", "branch_of"),
        *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n_quoted", "n_linked")),
        F.coalesce("quote_depth", F.lit(0)).cast("bigint").alias("quote_depth"),
    )
    own = F.array_join(F.filter("lines", lambda x: x["level"] == 0)["text"], "\n")
    text = F.when(F.col("row.text").isNotNull(), F.regexp_replace(own, r"^\s+|\s+$", "")).alias("own_text")
    df = df.select("row", "conv_id", "turn", text)
    return df.join(linked, ["conv_id", "turn"], "left").drop("conv_id", "turn")
