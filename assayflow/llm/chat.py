"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every turn becomes one marked piece; a conversation's formatted text is its pieces in
order. Every assistant turn becomes an example of its own: the context is the formatted
text of all turns before it, the target its own piece, and only the reply inside the
target is trainable.

Every example is written with its context in full, and all results are taken from what is read back.
An example is one row, or, where its context is long, several rows in order (`parts`), so that no row
and no task holds a whole long conversation. Contexts overlap, so the output is quadratic in the turns
of a conversation, as the expansion is: nothing is cut. `resolve` gives the sizes of the examples
without writing them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayflow.llm.common import discard, staged, whole_text

OPEN, CLOSE = "<turn>", "</turn>\n"
#: Positions of one conversation are counted in slices of so many turn numbers, then the slices are added up.
SLICE = 256
#: Pieces that begin within the same so many characters of a conversation are written as one part of an example.
PART_CHARS = 65_536
#: Rows of a row group of written examples: a reader holds the texts of one row group at once.
GROUP_ROWS = 64


def escape(text: Column) -> Column:
    r"""Text without `<`, hence without any marker: `\` becomes `\b`, `<` becomes `\l`."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    r"""The inverse of `escape`: after every `\l` is back, each `\b` is a backslash."""
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    r"""As `escape`, and a line feed becomes `\n`, as the first line feed of a piece ends its role."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _before(rows: DataFrame, part: Column, order: list[Column], counted: dict[str, Column]) -> DataFrame:
    """The rows with, for every name, the sum of its column over the rows before in their conversation.

    A conversation may hold a large part of all rows, so sums are taken within slices of it, and
    the few slice totals are then summed along the conversation.
    """
    rows = rows.withColumn("part", part)
    slices = rows.groupBy("conv_id", "part").agg(*(F.sum(c).alias(n) for n, c in counted.items()))
    earlier = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("part")).rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select(
        F.col("conv_id").alias("of"),
        F.col("part").alias("of_part"),
        *(F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_ahead") for n in counted),
    )
    inside = Window.partitionBy("conv_id", "part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    within = rows.withColumns({f"{n}_inside": F.coalesce(F.sum(c).over(inside), F.lit(0)) for n, c in counted.items()})
    joined = within.join(slices, F.col("conv_id").eqNullSafe(F.col("of")) & F.col("part").eqNullSafe(F.col("of_part")))
    sums = {n: F.col(f"{n}_ahead") + F.col(f"{n}_inside") for n in counted}
    return joined.withColumns(sums).drop("part", "of", "of_part", *(f"{n}_{k}" for n in counted for k in ("ahead", "inside")))


def format_turns(turns: DataFrame) -> DataFrame:
    """One row per turn: conv_id, position from 1, piece, trainable, start_chars (characters of all pieces before).

    `turns` has conv_id, turn, role, text; other columns are ignored. Turns are ordered by
    turn (NULLs last), then role, then text; repeated rows are turns like any other. A NULL
    text or role is the empty string, and rows with a NULL conv_id form one conversation.
    An empty table gives no rows.
    """
    piece = F.concat(
        F.lit(OPEN), escape_role(whole_text("role")), F.lit("\n"), escape(whole_text("text")), F.lit(CLOSE)
    )
    rows = turns.select(
        "conv_id",
        "turn",
        F.col("role").alias("by_role"),
        F.col("text").alias("by_text"),
        piece.alias("piece"),
        (whole_text("role") == "assistant").alias("trainable"),
    )
    order = [F.asc_nulls_last("turn"), F.col("by_role"), F.col("by_text")]
    counted = {"n": F.lit(1), "start_chars": F.length("piece").cast("long")}
    placed = _before(rows, F.floor(F.col("turn") / SLICE), order, counted)
    return placed.select("conv_id", (F.col("n") + 1).alias("position"), "piece", "trainable", "start_chars")


def expand(formatted: DataFrame) -> DataFrame:
    """One example per assistant turn, from the result of `format_turns`; `parts` writes them out.

    conv_id; context_turns, context_chars: the context is that many first pieces of the conversation, the target
    the piece after them; loss_start, loss_chars: the trainable characters within the target, the escaped reply alone.
    """
    head = F.length(F.substring_index("piece", "\n", 1)) + 1
    return formatted.where("trainable").select(
        "conv_id",
        (F.col("position") - 1).alias("context_turns"),
        F.col("start_chars").alias("context_chars"),
        head.cast("long").alias("loss_start"),
        (F.length("piece") - head - len(CLOSE)).cast("long").alias("loss_chars"),
    )


def with_rests(formatted: DataFrame) -> DataFrame:
    """The examples of `expand` and, where a conversation ends with another turn, one more up to that turn
    with nothing to train on. `ends` marks the example with which its conversation ends."""
    turns = formatted.groupBy("conv_id").agg(
        F.max("position").alias("n"),
        F.coalesce(F.max(F.when(F.col("trainable"), F.col("position"))), F.lit(0)).alias("replied"),
        F.max("start_chars").alias("context_chars"),
    )
    none = F.lit(0).cast("long")
    rests = turns.where("replied < n").select(
        "conv_id", (F.col("n") - 1).alias("context_turns"), "context_chars", none.alias("loss_start"), none.alias("loss_chars")
    )
    last = turns.select(F.col("conv_id").alias("of"), "n")
    every = expand(formatted).unionByName(rests).join(last, F.col("conv_id").eqNullSafe(F.col("of")))
    return every.withColumn("ends", F.col("context_turns") + 1 == F.col("n")).drop("of", "n")


def resolve(formatted: DataFrame, examples: DataFrame) -> DataFrame:
    """The examples with what they refer to: conv_id, position and target, the piece after the context, and
    context_chars, example_chars: the characters of the context, and of context and target together."""
    placed = formatted.select(F.col("conv_id").alias("of"), "position", "piece", "start_chars")
    same = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("position") == F.col("context_turns") + 1)
    return examples.join(placed, same).select(
        "conv_id",
        "position",
        "context_turns",
        F.col("start_chars").alias("context_chars"),
        F.col("piece").alias("target"),
        "loss_start",
        "loss_chars",
        (F.col("start_chars") + F.length("piece")).alias("example_chars"),
    )


def parts(formatted: DataFrame, examples: DataFrame) -> DataFrame:
    """The examples written out: conv_id, position, part, context, target, loss_start, loss_chars, and what other
    columns the examples have.

    The context of an example is that of all its rows, in the order of part; a row has the pieces which begin within
    PART_CHARS characters of the conversation, and the last one the target. Most conversations have one part. The
    output is quadratic in the turns of a conversation, as every context repeats all turns before it; the parts of a
    long conversation are made by as many tasks.
    """
    part_of = lambda chars: F.floor(F.col(chars) / PART_CHARS)
    # Keys without NULL, so that the join takes the texts as grouped, without another shuffle.
    key = {"of": F.coalesce("conv_id", F.lit(0).cast("long")), "lost": F.col("conv_id").isNull()}
    texts = formatted.groupBy(*(c.alias(n) for n, c in key.items()), part_of("start_chars").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("position", "piece"))).alias("pieces")
    )
    to_own = F.explode(F.sequence(F.lit(0).cast("long"), "own"))
    marks = examples.withColumn("own", part_of("context_chars")).withColumn("part", to_own).withColumns(key)
    joined = marks.join(texts, [*key, "part"])
    before = F.least(F.col("context_turns") + 1 - F.col("pieces")[0]["position"], F.size("pieces").cast("long")).cast("int")
    last = lambda value: F.when(F.col("part") == F.col("own"), value)
    known = ["conv_id", "context_turns", "context_chars", "loss_start", "loss_chars"]
    return joined.select(
        "conv_id",
        (F.col("context_turns") + 1).alias("position"),
        "part",
        F.array_join(F.slice("pieces.piece", F.lit(1), before), "").alias("context"),
        last(F.get("pieces.piece", before)).alias("target"),
        last(F.col("loss_start")).alias("loss_start"),
        last(F.col("loss_chars")).alias("loss_chars"),
        *(c for c in examples.columns if c not in known),
    )


def _joined(order: str, text: str) -> Column:
    """The texts of a group, without NULLs, in the order of a column, as one text."""
    in_order = F.array_sort(F.collect_list(F.when(F.col(text).isNotNull(), F.struct(order, text))))
    return F.array_join(F.transform(in_order, lambda x: x[text]), "")


def render(formatted: DataFrame, examples: DataFrame) -> DataFrame:
    """The examples with their parts put together: conv_id, position, context, target, loss_start, loss_chars.

    A row holds a whole context; it is meant for conversations that fit a model.
    """
    return assemble(parts(formatted, examples))


def assemble(written: DataFrame) -> DataFrame:
    """As `render`, from the parts as written."""
    only = [F.max(c).alias(c) for c in ("target", "loss_start", "loss_chars")]
    return written.groupBy("conv_id", "position").agg(_joined("part", "context").alias("context"), *only)


def trainable_text() -> Column:
    """The unescaped text under the loss mask of a written example; NULL in the parts before the target."""
    return unescape(F.substring(F.col("target"), F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int")))


def _role_and_text(inner: Column) -> tuple[Column, Column]:
    """Role and text of a piece without its marks; the first line feed parts them."""
    cut = F.locate("\n", inner)
    return unescape_role(F.substring(inner, F.lit(1), cut - 1)), unescape(F.substring(inner, cut + 1, F.length(inner)))


def read_turns(formatted: DataFrame) -> DataFrame:
    """The turns parsed back from the formatted pieces: conv_id, position, role, text."""
    inner = F.expr(f"substring(piece, {len(OPEN) + 1}, length(piece) - {len(OPEN) + len(CLOSE)})")
    role, text = _role_and_text(F.col("inner"))
    return formatted.select("conv_id", "position", inner.alias("inner")).select(
        "conv_id", "position", role.alias("role"), text.alias("text")
    )


def write_examples(turns: DataFrame) -> DataFrame:
    """The output, read back: the `parts` of every assistant turn with its context, and of the rests of `with_rests`."""
    formatted, pieces = staged(format_turns(turns), "chat-pieces")
    group = {"parquet.block.row.count.limit": GROUP_ROWS}
    written, _ = staged(parts(formatted, with_rests(formatted)), "chat-examples", **group)
    discard(turns.sparkSession, pieces)
    return written


def digests(turns: DataFrame) -> DataFrame:
    """`read_digests` of the examples of all turns."""
    return read_digests(write_examples(turns))


def read_digests(written: DataFrame) -> DataFrame:
    """Per conversation, from examples read back alone: turns and trainable text with their digests.

    formatted_chars is the size of the expansion: the characters of all examples, contexts
    included, and, where the last turn is not an assistant's, of the whole conversation once
    more, as that remainder is in no example. The turns are parsed from the example that ends
    its conversation, each reply is what its own example has under the loss mask.

    A digest of a conversation takes its whole text in one row of one task, as SHA-256 goes from front to
    back; a row holds less than 2 GB.
    """
    # No mark is left in a text, so the end of a piece ends it wherever it stands; nothing follows the last one.
    target = F.coalesce("target", F.lit(""))
    ended = F.split(F.concat("context", target), CLOSE, -1)
    inner = F.transform(F.slice(ended, F.lit(1), F.size(ended) - 1), lambda p: F.substring(p, F.lit(len(OPEN) + 1), F.length(p)))
    said = F.transform(inner, lambda p: F.concat(_role_and_text(p)[0], F.lit("\n"), _role_and_text(p)[1], F.lit("\n")))
    rows = written.select(
        "conv_id",
        "position",
        "part",
        (F.length("context") + F.length(target)).cast("long").alias("chars"),
        trainable_text().alias("reply"),
        F.when(F.col("ends"), said).alias("turns"),
    ).withColumns({"said": F.array_join("turns", ""), "n_said": F.when(F.col("turns").isNotNull(), F.size("turns"))})
    grouped = rows.groupBy("conv_id").agg(
        F.sum("n_said").alias("n_turns"),
        _joined("part", "said").alias("said"),
        _joined("position", "reply").alias("reply"),
        F.sum("chars").alias("formatted_chars"),
    )
    return grouped.select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.length("reply").cast("long").alias("loss_chars"),
        F.sha2(F.col("reply").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
