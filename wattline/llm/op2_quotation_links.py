"""Conversations from messages that quote each other.

Lines that begin with quote marks (``>``, nested ones repeated) form quoted passages: runs of lines of the same depth.
Attribution lines in front of them and marker lines go with them. A passage's normalised form (lower case, letters and
digits, single spaces) is hashed, whole and line by line; so are every message's own text, its paragraphs and lines.
A join on conversation and hash finds the original: the latest earlier message of the conversation that holds it. A
message answers the original with the most quoted characters at the first depth (the latest, if equal); deeper passages
are linked too. Without a link, it carries on from the message before it.

Reading order: sorted by ``place``, an answer to an earlier message stands directly behind that message, with what
carries on from it, before the line that it left goes on. Running values over turns are taken in segments first and
then over the segments, so that a conversation of any length is spread out.

Defined results: null text gives null text and no link; a text of quotes only becomes empty; messages without a
conversation or turn are kept, unlinked; repeated messages (same conversation and turn) each get a row, links go to the
turn; other columns are carried, those that clash with made ones are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattline.session import materialize

SEGMENT = 1024
MADE = ["reply_to", "place", "n_quoted", "n_linked", "format"]

# fixed values: how mail programs announce a quote
ATTRIBUTION = (
    r"^\s*(on\b.{1,300}\bwrote|am\b.{1,300}\bschrieb.{0,200}|le\b.{1,300}\ba écrit|el\b.{1,300}\bescribió)\s*:\s*$"
    r"|^\s*-{2,}\s*(original|forwarded) message\s*-{2,}\s*$"
)


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def parse_lines(text: Column) -> Column:
    """Array of lines as (depth, body, attribution)."""
    lines = F.split(text, r"\r?\n")

    def line(x):
        marks = F.regexp_extract(x, r"^((?:\s{0,3}>)+)", 1)
        return F.struct(
            F.length(F.regexp_replace(marks, r"[^>]", "")).cast("int").alias("depth"),
            F.when(marks == "", x).otherwise(F.regexp_replace(x, r"^(?:\s{0,3}>)+ ?", "")).alias("body"),
            F.lower(x).rlike(ATTRIBUTION).alias("says"),
        )

    return F.transform(lines, line)


def own_text(lines: Column) -> Column:
    """Lines of depth 0, without an attribution directly in front of a quote."""
    after = lambda i: F.coalesce(F.get(lines, i + 1)["depth"] > 0, F.lit(False))
    kept = F.filter(lines, lambda x, i: (x["depth"] == 0) & ~(x["says"] & after(i)))
    text = F.concat_ws("\n", F.transform(kept, lambda x: x["body"]))
    return F.trim(F.regexp_replace(F.regexp_replace(text, r"\n[ \t\r]*(?:\n[ \t\r]*)+", "\n\n"), r"^\s+|\s+$", ""))


def running_max(df: DataFrame, keys: list[str], turn: str, value: str, name: str, before: bool) -> DataFrame:
    """Largest ``value`` on earlier turns of the keys (``before``), or up to the row's own turn."""
    cut = df.withColumn("__seg", F.floor(F.col(turn) / SEGMENT))
    inner = Window.partitionBy(*keys, "__seg").orderBy(turn).rangeBetween(Window.unboundedPreceding, -1 if before else 0)
    sums = cut.groupBy(*keys, "__seg").agg(F.max(value).alias("__v"))
    outer = Window.partitionBy(*keys).orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, "__seg", F.max("__v").over(outer).alias("__earlier"))
    joined = cut.withColumn("__here", F.max(value).over(inner)).join(sums, [*keys, "__seg"], "left")
    return joined.withColumn(name, F.greatest("__here", "__earlier")).drop("__seg", "__here", "__earlier")


def link_quotes(df: DataFrame, conv: str = "conv_id", turn: str = "turn", text: str = "text", role: str = "role", min_chars: int = 8) -> DataFrame:
    """All rows and columns, with ``text`` freed of quotes, ``reply_to`` (turn), ``place`` (its key in reading order),
    ``n_quoted`` passages, ``n_linked`` of them, and ``format``: the message as a role-marked block."""
    columns = [c for c in df.columns if c not in MADE]
    rows = df.select(*[F.col(f"`{c}`") for c in columns]).withColumn("__lines", parse_lines(F.col(f"`{text}`")))
    rows = rows.withColumn("__own", F.when(F.col("__lines").isNotNull(), own_text(F.col("__lines"))))
    usable = rows.where(F.col(conv).isNotNull() & F.col(turn).isNotNull())
    base = usable.select(F.col(conv).alias("c"), F.col(turn).cast("bigint").alias("t"), F.col("__lines").alias("lines"), F.col("__own").alias("own")).distinct()

    # what each message says itself: whole, by paragraph and by line
    pieces = F.concat(F.array("own"), F.split("own", "\n\n"), F.split("own", "\n"))
    said = base.where("own IS NOT NULL").select("c", "t", F.explode(F.array_distinct(F.transform(pieces, normalised))).alias("piece"))
    said = said.where(F.col("piece") != "").select("c", "t", F.xxhash64("piece").alias("h")).distinct()

    # what each message quotes: runs of lines of one depth, whole and by line
    quoting = base.where(F.exists("lines", lambda x: x["depth"] > 0))
    # a message's lines are numbered and grouped by changes of depth; messages of one turn are told apart by their lines
    lines = quoting.select("c", "t", F.xxhash64("lines").alias("m"), F.posexplode("lines").alias("i", "line"))
    in_order = Window.partitionBy("c", "t", "m").orderBy("i")
    changed = F.coalesce(F.col("line.depth") != F.lag("line.depth").over(in_order), F.lit(False))
    lines = lines.withColumn("changed", changed.cast("int"))
    lines = lines.withColumn("p", F.sum("changed").over(in_order)).where("line.depth > 0")
    together = F.array_sort(F.collect_list(F.struct("i", F.col("line.body").alias("body"))))
    runs = lines.groupBy("c", "t", "m", "p").agg(F.first("line.depth").alias("depth"), F.array_join(F.transform(together, lambda x: x["body"]), "\n").alias("body"))
    passages = materialize(runs.where("trim(body) <> ''").select("c", "t", "p", "depth", "body"))
    units = passages.select("c", "t", "p", "depth", F.explode(F.concat(F.array(F.struct(F.lit(True).alias("whole"), normalised(F.col("body")).alias("u"))), F.transform(F.split("body", "\n"), lambda x: F.struct(F.lit(False).alias("whole"), normalised(x).alias("u"))))).alias("x"))
    units = units.select("c", "t", "p", "depth", F.col("x.whole").alias("whole"), F.length("x.u").alias("size"), F.xxhash64("x.u").alias("h")).where((F.col("size") > 0) & (F.col("whole") | (F.col("size") >= min_chars))).distinct()

    # the latest earlier message with the same hash: own pieces and quotes in one running maximum
    wanted = units.select("c", "h").distinct()
    both = said.join(wanted, ["c", "h"], "left_semi").select("c", "h", "t", F.col("t").alias("held")).unionByName(
        units.select("c", "h", "t").distinct().withColumn("held", F.lit(None).cast("bigint"))
    )
    found = running_max(both, ["c", "h"], "t", "held", "origin", before=True).where("held IS NULL AND origin IS NOT NULL")
    hits = units.join(found.select("c", "h", "t", "origin").distinct(), ["c", "h", "t"])
    linked = hits.groupBy("c", "t").agg(F.countDistinct("p").alias("n_linked"))
    weight = hits.groupBy("c", "t", "p", "depth", "origin").agg(F.max(F.when(F.col("whole"), F.col("size"))).alias("w"), F.sum(F.when(~F.col("whole"), F.col("size"))).alias("l"))
    weight = weight.groupBy("c", "t", "origin").agg(F.min("depth").alias("depth"), F.sum(F.coalesce("w", "l")).alias("size"))
    best = weight.groupBy("c", "t").agg(F.max_by("origin", F.struct(-F.col("depth"), "size", "origin")).alias("origin"))
    counts = passages.groupBy("c", "t").agg(F.countDistinct("p").alias("n_quoted"))
    links = materialize(counts.join(linked, ["c", "t"], "left").join(best, ["c", "t"], "left"))

    # branches: a link to anything but the message before leaves the line and starts one behind its original
    turns = base.select("c", "t").distinct().join(links, ["c", "t"], "left").withColumn("own_turn", F.col("t"))
    turns = running_max(turns, ["c"], "t", "own_turn", "previous", before=True)
    turns = turns.withColumn("here", F.when(F.col("origin") < F.col("previous"), F.col("t")))
    turns = materialize(running_max(turns, ["c"], "t", "here", "branch", before=False))
    branches = turns.where("here IS NOT NULL").select("c", "t", "origin")
    home = turns.select("c", F.col("t").alias("origin"), F.col("branch").alias("next"))
    paths = materialize(branches.join(home, ["c", "origin"]).select("c", "t", "next", F.array("origin", "t").alias("path")))
    while paths.where("next IS NOT NULL").limit(1).count():  # each round doubles how far back paths reach
        above = paths.select("c", F.col("t").alias("next"), F.col("next").alias("further"), F.col("path").alias("head"))
        joined = paths.join(above, ["c", "next"], "left")
        paths = materialize(joined.select("c", "t", F.col("further").alias("next"), F.concat(F.coalesce("head", F.array().cast("array<bigint>")), "path").alias("path")))
    placed = turns.join(paths.select("c", F.col("t").alias("branch"), "path"), ["c", "branch"], "left").select(
        "c", "t", F.coalesce("origin", "previous").alias("reply_to"),
        F.concat(F.coalesce("path", F.array().cast("array<bigint>")), F.array("t")).alias("place"),
        F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
    )
    placed = placed.withColumnsRenamed({"c": "__c", "t": "__t"})
    out = rows.join(placed, (F.col(conv) == F.col("__c")) & (F.col(turn).cast("bigint") == F.col("__t")), "left")
    block = F.concat(F.lit("<|"), F.coalesce(F.col(role) if role in columns else F.lit(None), F.lit("user")), F.lit("|>\n"), F.coalesce("__own", F.lit("")))
    made = {text: F.col("__own"), "reply_to": F.col("reply_to"), "place": F.col("place"), "n_quoted": F.coalesce("n_quoted", F.lit(0)), "n_linked": F.coalesce("n_linked", F.lit(0)), "format": block}
    return out.select(*[made[c].alias(c) if c == text else F.col(f"`{c}`") for c in columns], *[made[c].alias(c) for c in MADE])

