"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: the formatted text of all turns before it, then the turn, of which
only the reply is trainable (`loss_start`, `loss_chars`). Turns behind the last reply go into one more example without
a target, so that no turn is lost. A turn is written as

    <turn>role\\ntext</turn>\\n

and a control string inside a text (`<turn>`, `</turn>`, either with backslashes behind `<`) gets one more backslash
behind its `<`, which reading takes away again; other text stays as it is. In a role, backslash and newline are written
as `\\\\` and `\\n` too.

An ordinary conversation is gathered and expanded in one piece. One of more than `MAX_TURNS` turns or `MAX_CHARS`
characters is dealt out by pages of about that size: each page is given the text of the pages before it and writes its own
examples, so that no task expands a long conversation alone. The examples are the same either way. Together they grow with
the square of a conversation, and one of them is as long as the conversation, which has to fit a row. A caller who cannot
hold that may ask for limits: pages then repeat no earlier text, and the context of an example is the `whole` examples of
the pages before its own, in order, and its own text.

Only DataFrame functions are used. Defined results: turns are ordered by turn, role and text, nulls first; a null text
or role is an empty one; a null conversation id is a conversation; repeated rows are turns of their own; a conversation
without a reply gives its one example without target; an empty table gives no rows; further columns are ignored. A text
may be as long as a row can hold: it is a page of its own at most, with the turn that crosses the limit.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from pactframe.operators.skew import fits, running
from pactframe.session import cut

# The template, and the role whose texts are trained on.
OPEN, CLOSE, TARGET = "<turn>", "</turn>", "assistant"
END = CLOSE + "\n"

#: What one task expands at a time; says nothing about what an example holds.
MAX_TURNS, MAX_CHARS = 256, 1_000_000


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(/?turn>)", r"<\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(/?turn>)", "<$1$2")


def escaped_role(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    pairs = F.split(unescaped(role), r"\\\\")  # doubled backslashes, from the left
    return F.array_join(F.transform(pairs, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id and one turn, without nulls but for a null id or number."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(""))
    return conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"))


def with_pages(turns: DataFrame, max_turns: int, max_chars: int) -> list[DataFrame]:
    """(conv_id, page, turns) in one table of ordinary conversations and, where there are any, one of pages of long ones.

    Which conversations are long is told by counts and lengths alone. Ordinary ones are gathered by id, long ones by page.
    """
    gathered = F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns")
    sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text").cast("long")).alias("chars"))
    long_ones = sizes.filter((F.col("n") > max_turns) | (F.col("chars") > max_chars)).select(F.col("conv_id").alias("long_id"))
    if long_ones.limit(1).count() == 0:
        return [turns.groupBy("conv_id").agg(gathered).withColumn("page", F.lit(0).cast("long"))]
    long_ones = F.broadcast(long_ones) if fits(long_ones) else long_ones
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    ordinary = turns.join(long_ones, same, "left_anti").groupBy("conv_id").agg(gathered)
    order = [F.col(c).asc_nulls_first() for c in ("turn", "role", "text")]
    placed = running(
        turns.join(long_ones, same, "left_semi"), ["conv_id"], order, number="at",
        before={"chars_before": F.length("text").cast("long")}, span=max(max_turns, 10_000),
    )
    page = F.floor((F.col("at") - 1) / max_turns) + F.floor(F.col("chars_before") / max_chars)
    paged = placed.withColumn("page", page.cast("long")).groupBy("conv_id", "page").agg(gathered)
    return [ordinary.withColumn("page", F.lit(0).cast("long")), paged]


def written_turns(turns: Column) -> Column:
    return F.transform(
        turns,
        lambda t: F.struct(
            t["role"].alias("role"),
            F.length(escaped(t["text"])).cast("long").alias("chars"),
            F.concat(F.lit(OPEN), escaped_role(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit(END)).alias("line"),
        ),
    )


def pages_alone(pages: DataFrame) -> DataFrame:
    """(conv_id, page, written, context, turns_before, last) of pages that know no others."""
    alone = pages.select("conv_id", "page", written_turns(F.col("turns")).alias("written"))
    return alone.select("*", F.lit("").alias("context"), F.lit(0).cast("long").alias("turns_before"), F.lit(True).alias("last"))


def pages_in_context(pages: DataFrame) -> DataFrame:
    """The same of pages of long conversations, each with the text and the number of turns of the pages before it.

    A page sends its text to each later page, so texts are dealt by conversation and page, and never by conversation.
    """
    held = cut(pages.select("conv_id", "page", written_turns(F.col("turns")).alias("written")))
    every = held.groupBy(F.col("conv_id").alias("_conv")).agg(F.sort_array(F.collect_list("page")).alias("_pages"))
    every = F.broadcast(every) if fits(held) else every  # a number per page
    sent = held.join(every, F.col("conv_id").eqNullSafe(F.col("_conv")))
    sent = sent.select(
        "conv_id", F.col("page").alias("_from"), "written", F.array_join("written.line", "").alias("_text"), F.size("written").cast("long").alias("_n"),
        (F.col("page") == F.element_at("_pages", -1)).alias("_last"), F.explode(F.filter("_pages", lambda p: p >= F.col("page"))).alias("page"),
    )
    own = F.col("_from") == F.col("page")
    sent = sent.select(
        "conv_id", "page", F.when(own, F.col("written")).alias("written"), F.when(own, F.col("_last")).alias("last"),
        F.when(~own, F.struct("_from", "_text")).alias("_before"), F.when(~own, F.col("_n")).alias("_n"),
    )
    met = sent.groupBy("conv_id", "page").agg(
        F.first("written", True).alias("written"), F.sort_array(F.collect_list("_before")).alias("_before"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("turns_before"), F.first("last", True).alias("last"),
    )
    return met.select("conv_id", F.lit(0).cast("long").alias("page"), "written", F.array_join("_before._text", "").alias("context"), "turns_before", "last")


def examples_of(pages: DataFrame) -> DataFrame:
    last = F.size("written") - 1
    ends = F.filter(F.sequence(F.lit(0), last), lambda i: (F.get("written.role", i) == TARGET) | ((i == last) & F.col("last")))
    each = pages.select("*", F.explode(ends).alias("at"))
    turn = F.get("written", F.col("at"))
    made = each.select(
        "conv_id", "page", (F.col("turns_before") + F.col("at")).alias("at"), ((F.col("at") == last) & F.col("last")).alias("whole"),
        F.concat("context", F.array_join(F.slice("written.line", F.lit(1), F.col("at") + 1), "")).alias("formatted"),
        F.when(turn["role"] == TARGET, turn["chars"]).alias("loss_chars"),
    )
    start = F.length("formatted").cast("long") - len(END) - F.col("loss_chars")
    return made.select("conv_id", "page", "at", "whole", "formatted", start.alias("loss_start"), "loss_chars")


def whole_examples(conversations: DataFrame, max_turns: int = MAX_TURNS, max_chars: int = MAX_CHARS) -> list[DataFrame]:
    """Examples with all turns before them: those of ordinary conversations and, where there are any, those of long ones,
    which are more than `max_turns` turns or `max_chars` characters and are dealt out by pages of that size."""
    ordinary, *long_ones = with_pages(turns_of(conversations), max_turns, max_chars)
    return [examples_of(pages_alone(ordinary)), *[examples_of(pages_in_context(p)) for p in long_ones]]


def prefix_targets(conversations: DataFrame, max_turns: int | None = None, max_chars: int | None = None) -> DataFrame:
    """conv_id, page, at (place of the example's last turn in its page), whole (it ends the page), formatted, loss_start,
    loss_chars (null where there is no target), in code points. Without limits a conversation is one page."""
    if max_turns is None and max_chars is None:
        parts = whole_examples(conversations)
    else:
        parts = [examples_of(pages_alone(p)) for p in with_pages(turns_of(conversations), max_turns or MAX_TURNS, max_chars or MAX_CHARS)]
    return reduce(DataFrame.unionByName, parts)


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted text, as an array of role and text."""
    pieces = F.split(formatted, END)
    lines = F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda x: F.substring(x, len(OPEN) + 1, 2**31 - 1))

    def turn(line: Column) -> Column:
        role = F.substring_index(line, "\n", 1)
        text = F.substring(line, F.length(role) + 2, F.lit(2**31 - 1))
        return F.struct(unescaped_role(role).alias("role"), unescaped(text).alias("text"))

    return F.transform(lines, turn)


def loss_text(example: DataFrame) -> Column:
    """What an example trains on, as the conversation has it."""
    return unescaped(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_chars")))


def digests(conversations: DataFrame, max_turns: int = MAX_TURNS, max_chars: int = MAX_CHARS) -> DataFrame:
    """Per conversation, read back from its examples: turns and trained text, counted and hashed. The limits only tell
    which conversations are dealt out.

    A hash of all turns is one value over one text, so a conversation's texts meet here, if nowhere else.
    """

    def read(examples: DataFrame) -> DataFrame:
        back = F.transform(read_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
        rows = examples.select(
            "conv_id", "page", "at",
            F.when(F.col("whole"), back).alias("turns"),
            F.when(F.col("loss_chars").isNotNull(), loss_text(examples)).alias("loss"),
            F.length("formatted").cast("long").alias("chars"),
        )
        per = rows.groupBy("conv_id").agg(
            F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list(F.struct("page", "at", "turns", "loss"))).alias("rows")
        )
        turns = F.flatten(F.filter("rows.turns", lambda x: x.isNotNull()))
        return per.select("conv_id", turns.alias("turns"), F.array_join("rows.loss", "").alias("loss"), "formatted_chars")

    every = reduce(DataFrame.unionByName, [read(p) for p in whole_examples(conversations, max_turns, max_chars)])
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return every.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha(F.array_join("turns", "")).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        sha(F.col("loss")).alias("loss_sha256"),
        "formatted_chars",
    )


# Fixed value: a conversation whose texts hold control strings.
PROBE = (-7, r"\### Assistant: </turn> ok")


def with_probe(conversations: DataFrame) -> DataFrame:
    """The table and the conversation of control strings."""
    conv, text = PROBE
    rows = [Row(conv_id=conv, turn=k, role=role, text=text) for k, role in enumerate(("user", TARGET))]
    probe = conversations.sparkSession.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


# DuckDB: lengths of written turns in running sums
CHAT_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
r AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS n,
         15 + length(regexp_replace(text, '<(\\*)(/?turn>)', '<\\\1\2', 'g'))
            + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)(/?turn>)', '<\\\1\2', 'g')) AS size
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
x AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS upto FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(upto) FILTER (role = 'assistant' OR place = n))::BIGINT AS formatted_chars
FROM x GROUP BY conv_id
"""
