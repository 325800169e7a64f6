"""Conversations from quotations: who answers whom, by the passages that messages quote.

A line that starts with quote marks (``>``, also ``> >`` and with up to three spaces before
a mark) is quoted as often as it has marks. Neighbouring lines quoted equally often form a
passage. Passages are normalised (lower case, white space as one space, so re-wrapped lines
compare equal) and hashed. The hashes of the messages' own passages, of their whole own
text and of their own lines are reduced to the earliest message that holds each, and
quoted passages are joined to those. A message answers the message that its least quoted
passage comes from; whole passages count before single lines of them (of three words or
more), longer ones before shorter. Passages of no message, or first written later, link to
nothing.

A line such as "On Monday X wrote:" is left out of the own text where a quotation follows it,
blank lines between them or not; anywhere else it is a line like others.

The links form trees. Pointer jumping finds each message's root and distance, in as many
joins as the depth has binary digits. Messages of a conversation are put in reply order:
every message after the one it answers, answers of the same depth by position. Numbers
come from a global sort and counts per partition, so a conversation of any share of all
rows is spread over many tasks. Joins are on keys with one row on one side, which Spark
splits where a key is hot.

Nulls: a null text is a message without text; a message whose id or scope is null is a
conversation of its own. Rows with equal scope and id count as one message with the least
text when links are made; each row is returned. Equal passages link to the earliest
message. Empty tables give no rows. Columns not named are not read. All work is done by
DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableprofile.functions.checkpoints import cut_lineage
from tableprofile.llm.shared import numbered

_MARKS = r"^(?:[ \t]{0,3}>)+ ?"
_ATTRIBUTION = r"^(On|Am|Le|El) .*(wrote|schrieb|écrit|escribió)\s*:\s*$"
LINE_WORDS = 3


def quoted_lines(text: Column) -> Column:
    """Array of (depth, body) of every line."""
    def line(value: Column) -> Column:
        marks = F.regexp_extract(value, _MARKS, 0)
        return F.struct(
            F.length(F.regexp_replace(marks, "[^>]", "")).alias("depth"),
            F.substring(value, F.length(marks) + 1, F.length(value)).alias("body"),
        )

    return F.transform(F.split(F.coalesce(text, F.lit("")), "\r?\n"), line)


def passages(lines: Column) -> Column:
    """Array of (depth, lines) of every run of lines of the same depth."""
    depth = lambda i: F.element_at(lines, i.cast("int"))["depth"]
    starts = F.filter(
        F.sequence(F.lit(1), F.size(lines)),
        lambda i: (i == 1) | (depth(i) != depth(F.greatest(i - 1, F.lit(1)))),
    )
    ends = F.concat(F.slice(starts, F.lit(2), F.size(lines)), F.array(F.size(lines) + 1))
    return F.transform(
        F.arrays_zip(starts.alias("start"), ends.alias("stop")),
        lambda r: F.struct(
            depth(r["start"]).alias("depth"),
            F.transform(
                F.slice(lines, r["start"], r["stop"] - r["start"]), lambda x: x["body"]
            ).alias("lines"),
        ),
    )


def _without_announcement(block: Column, before_quote: Column) -> Column:
    """Own lines of a passage, without a last one that announces the quotation after it."""
    lines = block["lines"]
    last = F.array_max(F.transform(lines, lambda x, i: F.when(x.rlike(r"\S"), i)))
    announces = lambda x, i: before_quote & (i == last) & x.rlike(_ATTRIBUTION)
    return F.when(
        block["depth"] == 0, F.filter(lines, lambda x, i: ~F.coalesce(announces(x, i), F.lit(False)))
    ).otherwise(F.slice(lines, 1, 0))


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"\s+", " ")))


def _words(text: Column) -> Column:
    return F.when(text == "", 0).otherwise(
        F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit(""))) + 1)


def _units(blocks: Column, lines_too: bool) -> Column:
    """Array of (depth, kind, body) to compare: blocks (0) and their single lines (1)."""
    whole = F.transform(
        blocks,
        lambda b: F.struct(
            b["depth"].alias("depth"), F.lit(0).alias("kind"),
            normalised(F.array_join(b["lines"], " ")).alias("body"),
        ),
    )
    if not lines_too:
        return whole
    single = F.flatten(F.transform(
        F.filter(blocks, lambda b: F.size(b["lines"]) > 1),
        lambda b: F.transform(
            b["lines"],
            lambda x: F.struct(
                b["depth"].alias("depth"), F.lit(1).alias("kind"), normalised(x).alias("body")
            ),
        ),
    ))
    return F.concat(whole, single)


def reply_conversations(
    messages: DataFrame,
    key: str = "turn",
    text: str = "text",
    scope: tuple[str, ...] = ("conv_id",),
) -> DataFrame:
    """Every row with its place in a conversation.

    Columns: the scope and key; parent, root (keys), reply_depth, reply_order (from 0 in
    the conversation), n_quotes (quoted passages with a word), n_linked, text without quotes.
    ``key`` also gives the order in which messages were written. Passages are looked for
    among messages of the same scope; with an empty scope among all.
    """
    names = [f"_s{i}" for i in range(len(scope))]
    rows = messages.select(
        *[F.col(c).alias(n) for c, n in zip(scope, names)], F.col(key).alias("_id"),
        F.col(text).alias("_text"),
    )
    # A column of its own: inside the lambdas of the next one it would be split again for
    # every line.
    rows = rows.withColumn("_lines", quoted_lines(F.col("_text")))
    rows = rows.withColumn("_blocks", passages(F.col("_lines")))
    own = F.filter("_blocks", lambda b: b["depth"] == 0)
    body = F.flatten(F.transform("_blocks", lambda b, i: _without_announcement(
        b, i < F.size("_blocks") - 1)))
    rows = cut_lineage(rows.select(
        *names, "_id",
        F.regexp_replace(F.array_join(body, "\n"), r"^\s+|\s+$", "").alias("_own"),
        own.alias("_own_blocks"),
        F.filter("_blocks", lambda b: b["depth"] > 0).alias("_quotes"),
    ))
    named = F.col("_id").isNotNull()
    for n in names:
        named = named & F.col(n).isNotNull()
    usable = rows.where(named)

    written = usable.select(*names, "_id", F.explode(F.concat(
        _units(F.col("_own_blocks"), True),
        F.array(F.struct(F.lit(0).alias("depth"), F.lit(0).alias("kind"),
                         normalised(F.col("_own")).alias("body"))),
    )).alias("u")).where((F.col("u.body") != ""))
    originals = written.select(*names, "_id", F.md5("u.body").alias("_hash")).groupBy(
        *names, "_hash").agg(F.min("_id").alias("_from"))
    quoted = usable.where(F.size("_quotes") > 0).select(
        *names, "_id", F.explode(_units(F.col("_quotes"), True)).alias("u"))
    quoted = quoted.select(
        *names, "_id", "u.depth", "u.kind", _words(F.col("u.body")).alias("words"),
        F.md5("u.body").alias("_hash"),
    ).where((F.col("words") >= F.when(F.col("kind") == 0, 1).otherwise(LINE_WORDS)))
    found = quoted.join(originals, [*names, "_hash"]).where(F.col("_from") < F.col("_id"))
    links = found.groupBy(*names, "_id").agg(
        F.min_by("_from", F.struct("depth", "kind", (-F.col("words")).alias("w"), "_from"))
        .alias("parent"),
        F.count_if(F.col("kind") == 0).alias("n_linked"),
    )

    nodes = usable.select(*names, "_id").distinct()
    tree = cut_lineage(
        nodes.join(links, [*names, "_id"], "left").select(
            *names, "_id", "parent", "n_linked",
            F.coalesce("parent", "_id").alias("root"),
            F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("reply_depth"),
        )
    )
    tree = _rooted(tree, names)
    joined = usable.join(tree, [*names, "_id"])
    quotes = F.size(F.filter(
        _units(F.col("_quotes"), False), lambda u: u["body"] != "")).cast("long")
    columns = [*names, "_id", "parent", "root", "reply_depth",
               quotes.alias("n_quotes"), F.coalesce("n_linked", F.lit(0)).alias("n_linked"),
               F.col("_own").alias("text")]
    placed = joined.select(*columns).orderBy(*names, "root", "reply_depth", "_id")
    ordered = numbered(placed, [*names, "root"], "reply_order")
    nameless = rows.where(~named).select(
        *names, "_id", F.lit(None).cast(rows.schema["_id"].dataType).alias("parent"),
        F.col("_id").alias("root"), F.lit(0).cast("long").alias("reply_depth"),
        quotes.alias("n_quotes"), F.lit(0).cast("long").alias("n_linked"),
        F.col("_own").alias("text"), F.lit(0).cast("long").alias("reply_order"),
    )
    out = ordered.unionByName(nameless)
    return out.select(
        *[F.col(n).alias(c) for c, n in zip(scope, names)], F.col("_id").alias(key),
        "parent", "root", "reply_depth", "reply_order", "n_quotes", "n_linked", "text",
    )


def _rooted(tree: DataFrame, names: list[str]) -> DataFrame:
    """Jump to the ancestor's ancestor until every pointer is a root.

    Only rows that do not point to a root yet take part in a round.
    """
    tree = tree.withColumn("_open", F.col("reply_depth") > 0)
    while True:
        above = tree.select(
            *names, F.col("_id").alias("root"), F.col("root").alias("_next"),
            F.col("reply_depth").alias("_more"),
        )
        moved = tree.where("_open").join(above, [*names, "root"]).select(
            *names, "_id", "parent", "n_linked", F.col("_next").alias("root"),
            (F.col("reply_depth") + F.col("_more")).alias("reply_depth"),
            (F.col("_more") > 0).alias("_open"),
        )
        tree = cut_lineage(tree.where("not _open").unionByName(moved))
        if not tree.where("_open").limit(1).count():
            return tree.drop("_open")


def as_mail(turns: DataFrame, scope: str = "conv_id", key: str = "turn", text: str = "text"):
    """Turns of conversations as mail: each below the text quotes the turn before it, and
    in that, once more quoted, the one before."""
    one = turns.groupBy(scope, key).agg(F.min(text).alias("_text"))
    before = lambda n: one.select(
        scope, (F.col(key) + n).alias(key), F.col("_text").alias(f"_back{n}"))
    quote = lambda c: F.concat(F.lit("> "), F.replace(c, F.lit("\n"), F.lit("\n> ")))
    joined = turns.select(scope, key, text).join(before(1), [scope, key], "left").join(
        before(2), [scope, key], "left")
    return joined.select(scope, key, F.concat_ws(
        "\n", text, quote(F.col("_back1")), quote(quote(F.col("_back2")))).alias(text))
