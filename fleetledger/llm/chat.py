"""Chat formatting with a grammar round trip, in built-in functions only.

A turn is a text between its role's marks; a role without marks of its own is written as a
pair of its name and a pair of its text. The parser is deterministic: it cuts a formatted
text at every control string and reads the pieces as pairs of an opening and the matching
closing mark with nothing between pairs. Every turn is rendered as it is and parsed again;
where that does not give back the source, its content is escaped and parsed again, until
the two are identical. Whole segments are parsed once more and compared before they leave.

Escaping puts a backslash behind the first character of each control string, and of each
that already has backslashes there; unescaping takes one away. Such words never overlap, so
this is one to one, an escaped text holds no control string, and one escape always suffices.

A conversation leaves as segments of at most ``TURNS`` whole turns, whose texts follow one another.
Conversations above ``HOT_BYTES`` are sliced by ranges of their turns, so none is gathered in
one task, however long; only a digest of a whole conversation needs its text in one value.

Defined cases: a null text or role is empty; a null conversation id is a conversation. Turns go
by number (null first), equal ones by role and text; repeated rows are turns each. An empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin

TURNS = 64
HOT_BYTES = 4 << 20
ROW_BYTES = 64
BROADCAST_ROWS = 1_000_000

# Fixed values of the template: the marks of each role, and those of a role's name and its text.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
NAME, SAYS = ("[ROLE]", "[/ROLE]"), ("[SAYS]", "[/SAYS]")
LEARNED = "assistant"
CONTROL = r"</?s>|<</?SYS>>|\[/?(?:INST|ROLE|SAYS)\]"
# What follows the first character of a control string.
_REST = r"/?s>|</?SYS>>|/?(?:INST|ROLE|SAYS)\]"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*(?:{_REST}))", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*(?:{_REST}))", "$1$2")


def _by_role(role: Column, mark: int, other: Column) -> Column:
    found = other
    for name, marks in MARKS.items():
        found = F.when(role == name, F.lit(marks[mark])).otherwise(found)
    return found


def _lead(role: Column) -> Column:
    """What stands before a turn's text; a name is always escaped."""
    return _by_role(role, 0, F.concat(F.lit(NAME[0]), escape(role), F.lit(NAME[1] + SAYS[0])))


def _tail(role: Column) -> Column:
    return _by_role(role, 1, F.lit(SAYS[1]))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def parse(text: Column) -> Column:
    """The turns (role, text) of a formatted text; null if it doesn't keep to the grammar."""
    closing = F.create_map(*[F.lit(m) for pair in (*MARKS.values(), NAME, SAYS) for m in pair])
    cut = F.struct(F.regexp_extract_all(text, F.lit(CONTROL), 0).alias("marks"), F.split(text, CONTROL, -1).alias("pieces"))

    def paired(c: Column) -> Column:
        """(open, close, gap, body) of each pair of marks, by number; an odd mark at the end has no closing one."""
        numbers = F.when(F.size(c["marks"]) > 0, F.sequence(F.lit(0), F.floor((F.size(c["marks"]) - 1) / 2).cast("int"))).otherwise(
            F.array().cast("array<int>"))
        pairs = F.transform(numbers, lambda k: F.struct(
            F.get(c["marks"], 2 * k).alias("open"), F.get(c["marks"], 2 * k + 1).alias("close"),
            F.get(c["pieces"], 2 * k).alias("gap"), F.get(c["pieces"], 2 * k + 1).alias("body"),
            F.when(k > 0, F.get(c["marks"], F.greatest(2 * k - 2, F.lit(0)))).alias("last"),
            F.when(k > 0, F.get(c["pieces"], F.greatest(2 * k - 1, F.lit(0)))).alias("before")))
        return F.struct(pairs.alias("pairs"), F.element_at(c["pieces"], -1).alias("rest"), F.get(c["marks"], F.size(c["marks"]) - 2).alias("opened"))

    def sound(p: Column) -> Column:
        """Nothing between pairs, each closed by its own mark, and a name always followed by what it says."""
        return ((p["gap"] == "") & F.coalesce(F.element_at(closing, p["open"]) == p["close"], F.lit(False))
                & (F.coalesce(p["last"] == NAME[0], F.lit(False)) == (p["open"] == SAYS[0])))

    def turn(p: Column) -> Column:
        role = F.when(p["open"] == SAYS[0], unescape(p["before"]))
        for name, marks in MARKS.items():
            role = F.when(p["open"] == marks[0], F.lit(name)).otherwise(role)
        return F.struct(role.alias("role"), unescape(p["body"]).alias("text"))

    def read(c: Column) -> Column:
        whole = F.forall(c["pairs"], sound) & (c["rest"] == "") & F.coalesce(c["opened"] != NAME[0], F.lit(True))
        return F.when(whole, F.transform(F.filter(c["pairs"], lambda p: p["open"] != NAME[0]), turn))

    return _let(_let(cut, paired), read)


def _recovered(role: Column, text: Column, body: Column) -> Column:
    """Whether a turn with this body is read back as its role and text, and as nothing else."""
    source = F.array(F.struct(role.alias("role"), text.alias("text")))
    return F.coalesce(_let(F.concat(_lead(role), body, _tail(role)), parse) == source, F.lit(False))


def turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, escaped) of every row: whether its text has to be escaped to be read back."""
    plain = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))])
    role, text = F.col("role"), F.col("text")
    escaped = (F.when(_recovered(role, text, text), False).when(_recovered(role, text, escape(text)), True)
               .otherwise(F.raise_error(F.concat(F.lit("a turn is not read back: "), text)).cast("boolean")))
    return plain.withColumn("escaped", escaped)


def _segments(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """(keys, segment, turns): the turns of each group in order, at most ``TURNS`` in a segment."""
    gathered = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "escaped"))).alias("all"))
    numbers = F.sequence(F.lit(0), F.floor((F.size("all") - 1) / TURNS).cast("int"))
    cut = F.transform(numbers, lambda k: F.slice("all", k * TURNS + 1, TURNS))
    return gathered.select(*keys, F.posexplode(cut).alias("segment", "turns"))


def _formatted(segments: DataFrame) -> DataFrame:
    """``segments`` with their text and the spans under the loss mask; a text that is not read back raises."""
    parts = segments.withColumn("parts", F.transform("turns", lambda t: F.struct(
        _lead(t["role"]).alias("lead"), F.when(t["escaped"], escape(t["text"])).otherwise(t["text"]).alias("body"),
        _tail(t["role"]).alias("tail"), (t["role"] == LEARNED).alias("learned"))))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,end:long>>").alias("spans"))

    def step(a: Column, p: Column) -> Column:
        first = a["at"] + F.char_length(p["lead"])
        last = first + F.char_length(p["body"])
        spans = F.when(p["learned"], F.concat(a["spans"], F.array(F.struct(first.alias("start"), last.alias("end"))))).otherwise(a["spans"])
        return F.struct((last + F.char_length(p["tail"])).alias("at"), spans.alias("spans"))

    made = parts.select("conv", "slice", "segment", "turns",
                        F.array_join(F.transform("parts", lambda p: F.concat(p["lead"], p["body"], p["tail"])), "").alias("made"),
                        F.aggregate("parts", start, step)["spans"].alias("loss"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    same = F.coalesce(parse(F.col("made")) == source, F.lit(False))
    text = F.when(same, F.col("made")).otherwise(F.raise_error(F.lit("a segment is not read back")))
    return made.select("conv", "slice", "segment", text.alias("text"), "loss")


def conversations(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text", hot_bytes: int = HOT_BYTES) -> DataFrame:
    """(conv, slice, segment, text, loss): every conversation, formatted, in segments.

    Segments of a conversation follow one another by slice and segment. ``loss`` are the spans
    (code points, end exclusive) of its text that a model learns from: what assistants say.
    """
    every = turns(rows, conv_col, turn_col, role_col, text_col)
    size = F.sum(F.octet_length(text_col) + F.lit(ROW_BYTES)).alias("bytes")
    long = rows.groupBy(F.col(conv_col).alias("hot")).agg(F.coalesce(size, F.count("*") * ROW_BYTES).alias("bytes")).filter(F.col("bytes") > hot_bytes)
    found = long.agg(F.count("*").alias("groups"), F.sum("bytes").alias("bytes")).first()  # two numbers
    cold = lambda df: _segments(df, ("conv",)).withColumn("slice", F.lit(0))
    if not found.groups:
        return _formatted(cold(every))
    hot = F.broadcast(long) if found.groups <= BROADCAST_ROWS else long
    named = F.col("conv").eqNullSafe(F.col("hot"))
    # Equal turns are told apart by where they were read, so that no range is one key.
    marked = every.join(hot, named, "left_semi").withColumn("at", F.monotonically_increasing_id())
    sliced = pin(marked.repartitionByRange(found.bytes // hot_bytes + 1, "conv", "turn", "role", "text", "at")
                 .drop("at").withColumn("slice", F.spark_partition_id()))
    parts = cold(every.join(hot, named, "left_anti")).unionByName(_segments(sliced, ("conv", "slice")))
    return _formatted(parts)


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv, slice, segment, turns, learned, chars) of formatted segments, from their text and mask alone.

    ``turns`` are (role, text); ``learned`` is the text under the loss mask, unescaped.
    """
    learned = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    return formatted.select("conv", "slice", "segment", parse(F.col("text")).alias("turns"),
                            F.array_join(learned, "").alias("learned"), F.char_length("text").alias("chars"))


def digests(read: DataFrame) -> DataFrame:
    """(conv, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of whole conversations.

    SHA-256 reads a text from its start, so a conversation's segments meet in one row here, up to
    the two gigabytes that a string can hold.
    """
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    each = read.select("conv", F.size("turns").alias("n"), "chars", F.char_length("learned").alias("learned_chars"),
                       F.struct("slice", "segment", said.alias("said"), "learned").alias("part"))
    whole = each.groupBy("conv").agg(
        F.sum("n").alias("n_turns"), F.sum("learned_chars").alias("loss_chars"), F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("part")).alias("parts"))
    return whole.select("conv", "n_turns", F.sha2(F.array_join("parts.said", ""), 256).alias("turns_sha256"), "loss_chars",
                        F.sha2(F.array_join("parts.learned", ""), 256).alias("loss_sha256"), "formatted_chars")
