"""Chat formatting by quotation linking.

Lines that begin with ``>`` quote other messages, one level per ``>``. Runs of lines of
one level are passages. Passages and their lines are normalised and hashed, and found
again among what earlier messages of the conversation said themselves. A message
replies to the message that its outermost quotation comes from. Only DataFrame functions
are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .graph import stored

_QUOTE = r"^(?:[ \t]*>)+[ \t]?"
_WROTE = r"^.*\b(wrote|writes):[ \t]*$"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where lambdas read it often."""
    return F.get(F.transform(F.array(value), body), 0)


def passages(text: Column) -> Column:
    """Runs of lines of one quote level: array of (level, lines without their marks).

    A line like ``... wrote:`` directly before a deeper quotation belongs to neither.
    """
    lines = F.split(F.coalesce(text, F.lit("")), r"\r?\n")
    marked = F.transform(
        lines,
        lambda x: _let(
            F.regexp_extract(x, _QUOTE, 0),
            lambda mark: F.struct(
                F.length(F.translate(mark, " \t", "")).alias("level"),
                F.substring(x, F.length(mark) + 1, F.length(x)).alias("line"),
            ),
        ),
    )
    return _let(_let(marked, _told), _runs)


def _told(marked: Column) -> Column:
    """The lines but for introductions of quotations."""
    return F.filter(
        marked,
        lambda x, i: ~(
            F.coalesce(F.get(marked, i + 1)["level"] > x["level"], F.lit(False))
            & x["line"].rlike(_WROTE)
        ),
    )


def _runs(told: Column) -> Column:
    """The lines, cut where the level changes."""
    begins = F.filter(
        F.sequence(F.lit(0), F.size(told)),
        lambda i: (i < F.size(told))
        & ((i == 0) | (F.get(told, i)["level"] != F.get(told, i - 1)["level"])),
    )
    return _let(
        begins,
        lambda at: _let(
            F.transform(told, lambda x: x["line"]),
            lambda lines: F.transform(
                at,
                lambda b, k: F.struct(
                    F.get(told, b)["level"].alias("level"),
                    F.slice(
                        lines, b + 1, F.coalesce(F.get(at, k + 1), F.size(told)) - b
                    ).alias("lines"),
                ),
            ),
        ),
    )


def _plain(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"[\s>]+", " ")))


_MARKS = r"[^\p{L}\p{N}]+"
_END = r"(?<=[.!?])\s+"
_WINDOW = 3


def _units(lines: Column) -> Column:
    """Normalised texts to find a passage by: the whole of it, its paragraphs (lines
    between blank ones, joined), their sentences, and its lines."""

    def of(each: Column) -> Column:
        # Blank lines are empty by now; the rest of the text has no line breaks.
        marked = F.transform(each, lambda x: F.when(x == "", "\n").otherwise(x))
        joined = F.regexp_replace(F.array_join(marked, " "), r" +", " ")
        paragraphs = F.transform(F.split(joined, r"\s*\n\s*"), F.trim)
        sentences = F.flatten(F.transform(paragraphs, lambda x: F.split(x, _END)))
        whole = F.trim(F.regexp_replace(F.array_join(each, " "), r" +", " "))
        parts = F.concat(F.array(whole), paragraphs, F.transform(sentences, F.trim), each)
        return F.array_distinct(F.filter(parts, lambda x: x != F.lit("")))

    return _let(F.transform(lines, _plain), of)


def _words(lines: Column) -> Column:
    """The words of a passage, one space apart, without any marks."""
    return F.trim(F.regexp_replace(F.array_join(F.transform(lines, _plain), " "), _MARKS, " "))


def _window_keys(words: Column) -> Column:
    """Hashes of all windows of ``_WINDOW`` words."""
    return F.array_distinct(
        _let(
            F.split(words, " "),
            lambda w: F.transform(
                F.filter(F.sequence(F.lit(0), F.size(w)), lambda i: i + _WINDOW <= F.size(w)),
                lambda i: F.xxhash64(F.array_join(F.slice(w, i + 1, _WINDOW), " ")),
            ),
        )
    )


def link_quotes(df: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per message, without its quotations and in reply order.

    Gives ``conversation``, ``turn``, ``role``, ``body``, ``n_quoted`` (quoted
    passages), ``n_linked`` (those found), ``depth`` (deepest level), ``reply_to`` (turn
    of the message that the outermost found quotation, latest if several, comes from;
    null if none), ``thread`` (turn at the start of the chain of replies) and
    ``position`` in the conversation from 0: threads in the order of their starts,
    messages of a thread in the order of their turns, so that replies follow what they
    reply to.

    A passage comes from the latest earlier message that says all of it as a text,
    paragraph, sentence or line of its own, or else from the latest that says all its
    words (three at least) in a row, or else from that which says its longest paragraph,
    sentence or line found. Rows equal in all four columns are one
    message. Different messages with one turn are ordered by role and text, and a
    quotation of either is linked to the later one of them; they do not quote each
    other. Null texts are empty messages; null conversations form one conversation; null
    turns come first. Other columns are not read.

    Of a conversation, only turns and digests meet in one task, ``position`` excepted,
    which sorts the messages of up to 64 neighbouring thread starts.
    """
    messages = (
        df.select(
            F.col(conversation).alias("conv"),
            F.col(turn).alias("turn"),
            F.col(role).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        )
        .distinct()
        .withColumn("digest", F.md5(F.concat_ws("\0", F.coalesce("role", F.lit("")), "text")))
        .withColumn("passages", passages(F.col("text")))
    )
    messages = messages.withColumns(
        {
            "own": F.transform(
                F.filter("passages", lambda p: p["level"] == 0), lambda p: p["lines"]
            ),
            "quoted": F.transform(
                F.filter("passages", lambda p: p["level"] > 0),
                lambda p: F.struct(
                    p["level"].alias("level"),
                    _units(p["lines"]).alias("units"),
                    _words(p["lines"]).alias("words"),
                ),
            ),
        }
    )
    # With one own passage, all of it and the passage are the same.
    parts = F.when(F.size("own") > 1, F.flatten(F.transform("own", _units))).otherwise(
        F.array().cast("array<string>")
    )
    messages = stored(
        messages.select(
            "conv",
            "turn",
            "role",
            "digest",
            F.trim(F.array_join(F.flatten("own"), "\n")).alias("body"),
            F.array_distinct(F.concat(_units(F.flatten("own")), parts)).alias("said"),
            _words(F.flatten("own")).alias("words"),
            F.filter("quoted", lambda q: F.size(q["units"]) > 0).alias("quoted"),
        ),
        "messages",
    )
    replies = stored(_replies(messages), "replies")
    threads = _threads(replies)
    out = messages.select(
        "conv",
        "turn",
        "role",
        "digest",
        "body",
        F.size("quoted").cast("long").alias("n_quoted"),
        F.coalesce(F.array_max(F.transform("quoted", lambda q: q["level"])), F.lit(0)).alias("depth"),
    )
    same = ["conv", "turn", "digest"]
    out = _null_safe_join(out, threads, same).withColumns(
        {
            "n_linked": F.coalesce("n_linked", F.lit(0).cast("long")),
            "thread": F.when(F.col("reply_to").isNull(), F.col("turn")).otherwise(F.col("thread")),
        }
    )
    group = F.floor(F.col("thread") / 64)
    counted = out.withColumn("group", group)
    sizes = counted.groupBy("conv", "group").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("conv").orderBy("group")
    sizes = sizes.select("conv", "group", (F.sum("n").over(upto) - F.col("n")).alias("before"))
    inside = Window.partitionBy("conv", "group").orderBy("thread", "turn", "role", "body", "digest")
    placed = counted.withColumn("place", F.row_number().over(inside))
    placed = _null_safe_join(placed, sizes, ["conv", "group"])
    return placed.select(
        F.col("conv").alias(conversation),
        F.col("turn").alias(turn),
        F.col("role").alias(role),
        "body",
        "n_quoted",
        "n_linked",
        "depth",
        "reply_to",
        "thread",
        (F.col("before") + F.col("place") - 1).cast("long").alias("position"),
    )


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join in which null keys meet."""
    on = None
    for k in keys:
        same = left[k].eqNullSafe(right[k])
        on = same if on is None else on & same
    return left.join(right, on, "left").select(
        *[left[c] for c in left.columns], *[right[c] for c in right.columns if c not in keys]
    )


def _replies(messages: DataFrame) -> DataFrame:
    """(conv, turn, digest, reply_to, reply_digest, n_linked) of messages with links.

    Quotations and what was said meet by conversation and hash; a running maximum over
    the turns finds the latest earlier source, without pairs.
    """
    said = messages.select("conv", "turn", "digest", F.explode("said").alias("unit"))
    said = said.unionByName(_contained(messages)).select(
        "conv", "turn", "digest", "unit", F.lit(1).alias("kind"),
        F.lit(-1).alias("passage"), F.lit(0).alias("level"), F.lit(0.0).alias("size"),
    )
    # Words in a row come after the whole passage, and before parts of it.
    units = F.transform(
        "q.units", lambda u: F.struct(u.alias("unit"), F.length(u).cast("double").alias("size"))
    )
    words = F.struct(
        _told_words(F.col("q.words")).alias("unit"),
        (F.length(F.get("q.units", 0)) - F.lit(0.5)).cast("double").alias("size"),
    )
    asked = messages.select(
        "conv", "turn", "digest", F.posexplode("quoted").alias("passage", "q")
    ).select(
        "conv", "turn", "digest", F.explode(F.concat(units, F.array(words))).alias("u"),
        F.lit(0).alias("kind"), "passage", "q.level",
    ).select("conv", "turn", "digest", "u.unit", "kind", "passage", "level", "u.size")
    both = said.unionByName(asked).withColumn("key", F.xxhash64("unit"))
    before = (
        Window.partitionBy("conv", "key")
        .orderBy("turn", "kind", "digest")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    source = F.max(F.when(F.col("kind") == 1, F.struct("turn", "digest"))).over(before)
    found = (
        both.withColumn("source", source)
        .where((F.col("kind") == 0) & F.col("source").isNotNull() & (F.col("source.turn") < F.col("turn")))
    )
    linked = found.groupBy("conv", "turn", "digest", "passage", "level").agg(
        F.max(F.struct("size", "source")).alias("best")
    )
    return linked.groupBy("conv", "turn", "digest").agg(
        F.max(F.struct((-F.col("level")).alias("outer"), F.col("best.source").alias("source"))).alias("to"),
        F.count("*").alias("n_linked"),
    ).select(
        "conv", "turn", "digest", F.col("to.source.turn").alias("reply_to"),
        F.col("to.source.digest").alias("reply_digest"), "n_linked",
    )


def _told_words(words: Column) -> Column:
    """The unit of words in a row; no text of a message is like it."""
    return F.concat(F.lit("\n"), words)


def _contained(messages: DataFrame) -> DataFrame:
    """(conv, turn, digest, unit) of messages whose own words hold those of a passage.

    Texts meet by the window of a passage that the fewest texts of the conversation
    hold, equal texts and equal passages once, and are compared in full. Texts of
    conversations without passages are not cut into windows.
    """
    asked = messages.select("conv", F.explode("quoted.words").alias("part"))
    asked = asked.where(F.size(F.split("part", " ")) >= _WINDOW).distinct()
    asked = asked.withColumn("part_id", F.md5("part"))
    own = messages.select("conv", "turn", "digest", "words", F.md5("words").alias("text_id"))
    where = asked.select(F.col("conv").alias("c")).distinct()
    own = own.join(where, F.col("conv").eqNullSafe(F.col("c")), "left_semi")
    texts = own.select("conv", "text_id", "words").distinct()
    wanted = asked.select(
        F.col("conv").alias("c"), "part_id", F.explode(_window_keys(F.col("part"))).alias("k")
    )
    windows = texts.select("conv", "text_id", F.explode(_window_keys(F.col("words"))).alias("key"))
    meet = F.col("conv").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k"))
    windows = windows.join(wanted.select("c", "k").distinct(), meet, "left_semi")
    often = windows.groupBy("conv", "key").agg(F.count("*").alias("n"))
    rarest = (
        often.join(wanted, meet)
        .groupBy("c", "part_id")
        .agg(F.min(F.struct("n", "key"))["key"].alias("k"))
    )
    pairs = windows.join(rarest, meet).select(
        F.col("conv").alias("pair_conv"), F.col("text_id").alias("t"), F.col("part_id").alias("p")
    )
    same = F.col("conv").eqNullSafe(F.col("pair_conv"))
    pairs = pairs.join(texts, same & (F.col("text_id") == F.col("t"))).drop("conv")
    pairs = pairs.join(asked, same & (F.col("part_id") == F.col("p")))
    space = F.lit(" ")
    held = pairs.where(
        F.contains(F.concat(space, "words", space), F.concat(space, "part", space))
    ).select(F.col("conv").alias("c"), "t", _told_words(F.col("part")).alias("unit"))
    return own.join(
        held, F.col("conv").eqNullSafe(F.col("c")) & (F.col("text_id") == F.col("t"))
    ).select("conv", "turn", "digest", "unit")


def _threads(replies: DataFrame) -> DataFrame:
    """``replies`` with the turn at the start of each chain, by pointer doubling."""
    ends = replies.select(
        "conv", "turn", "digest",
        F.col("reply_to").alias("thread"), F.col("reply_digest").alias("thread_digest"),
    )
    while True:
        further = ends.select(
            "conv", F.col("turn").alias("t"), F.col("digest").alias("d"),
            F.col("thread").alias("thread2"), F.col("thread_digest").alias("digest2"),
        )
        joined = ends.alias("a").join(
            further.alias("b"),
            F.col("a.conv").eqNullSafe(F.col("b.conv"))
            & (F.col("thread") == F.col("t"))
            & (F.col("thread_digest") == F.col("d")),
            "left",
        )
        step = stored(
            joined.select(
                "a.conv", "turn", "digest",
                F.coalesce("thread2", "thread").alias("thread"),
                F.coalesce("digest2", "thread_digest").alias("thread_digest"),
                F.col("thread2").isNotNull().alias("moved"),
            ),
            "threads",
        )
        ends = step.drop("moved")
        if step.where("moved").isEmpty():
            break
    return _null_safe_join(
        replies.select("conv", "turn", "digest", "reply_to", "n_linked"),
        ends.select("conv", "turn", "digest", "thread"),
        ["conv", "turn", "digest"],
    )


def conversations(linked: DataFrame, conversation: str, role: str) -> DataFrame:
    """One row per conversation: its bodies in reply order as one chat text.

    A row holds a whole conversation, as its consumer asks for; messages without a body
    are left out.
    """
    line = F.struct("position", F.concat(F.coalesce(F.col(role), F.lit("")), F.lit(": "), "body").alias("line"))
    told = F.array_sort(F.collect_list(F.when(F.col("body") != "", line)))
    return linked.groupBy(conversation).agg(
        F.array_join(F.transform(told, lambda x: x["line"]), "\n\n").alias("chat")
    )
