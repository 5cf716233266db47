r"""Chat formatting by a grammar round trip, in DataFrame functions only.

Grammar of a formatted conversation:

    conversation := turn*
    turn         := "### " role ": " text "\n" "</turn>" "\n"

`### ` and `</turn>` are control strings. The parser splits at control strings that no backslash
precedes and removes one backslash before those that have some. A conversation is first rendered
as it is; where the parsed turns differ from the source, its texts are rendered again with one
more backslash before each control string, which always round-trips. Roles carry a short escape of
their own, so that the first ": " ends them. A conversation that would still differ stops the job.
"""

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "### ", "</turn>"
# Tried at the first backslash of a run only, so a run is read once.
CONTROL = r"(?<!\\)(\\*+)(### |</turn>)"
ESCAPED = r"(?<!\\)\\(\\*+)(### |</turn>)"
# The control string first, then what stands before it: most places fail at their first character.
TOKEN = r"(?:### |</turn>)(?<!\\(?:### |</turn>))"
ROLE_ESCAPES = [("\\", "\\b"), (":", "\\c"), ("#", "\\h"), ("<", "\\l")]


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1$2")


def unescape_text(text: Column) -> Column:
    return F.when(text.contains("\\"), F.regexp_replace(text, ESCAPED, "$1$2")).otherwise(text)


def escape_role(role: Column) -> Column:
    for plain, escaped in ROLE_ESCAPES:
        role = F.replace(role, F.lit(plain), F.lit(escaped))
    return role


def unescape_role(role: Column) -> Column:
    for plain, escaped in reversed(ROLE_ESCAPES):
        role = F.replace(role, F.lit(escaped), F.lit(plain))
    return role


def render(turns: Column, text) -> Column:
    """The formatted string of an array of (role, text); `text` maps a text to what is written."""
    one = lambda t: F.concat(
        F.lit(OPEN), escape_role(t["role"]), F.lit(": "), text(t["text"]), F.lit(f"\n{CLOSE}\n")
    )
    return F.array_join(F.transform(turns, one), "")


def pieces(formatted: Column) -> Column:
    """What lies between control strings: empty, a turn's body, a line end, a body, a line end, and so on."""
    return F.split(formatted, TOKEN)


def _bodies(parts: Column) -> Column:
    return F.filter(parts, lambda _, i: i % 2 == 1)


def _role(body: Column) -> Column:
    """The escaped role: all up to the first ": "."""
    return F.substring_index(body, ": ", 1)


def parse(parts: Column) -> Column:
    """Turns (role, text) of the pieces of a formatted string; null if it doesn't follow the grammar."""
    body = lambda p: p.contains(": ") & p.endswith("\n")
    place = lambda p, i: F.when(i % 2 == 1, body(p)).when(i == 0, p == "").otherwise(p == "\n")
    well_formed = (F.size(parts) % 2 == 1) & F.forall(F.transform(parts, place), lambda fits: fits)
    turn = lambda b: F.struct(
        unescape_role(_role(b)).alias("role"),
        unescape_text(F.substring(b, F.length(_role(b)) + 3, F.length(b) - F.length(_role(b)) - 3)).alias("text"),
    )
    return F.when(well_formed, F.transform(_bodies(parts), turn))


# Numbers that are added up together, and code points that are looked up together.
SUM_BLOCK, TEXT_BLOCK = 256, 1024


def _bound(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sums_before(numbers: Column) -> Column:
    """For each number of an array the sum of all before it, block by block: no running array is copied for every number."""
    add = lambda total, x: total + x
    total = lambda some: F.aggregate(some, F.lit(0).cast("long"), add)

    def blocked(all_numbers):
        last = F.floor((F.size(all_numbers) - 1) / SUM_BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(all_numbers, k * SUM_BLOCK + 1, SUM_BLOCK))
        start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast("array<bigint>").alias("before"))
        step = lambda s, block: F.struct(
            (s["total"] + total(block)).alias("total"), F.concat(s["before"], F.array(s["total"])).alias("before")
        )
        inside = lambda block, before: F.transform(block, lambda _, i: before + total(F.slice(block, F.lit(1), i)))
        with_bases = _bound(blocks, lambda parts: F.zip_with(parts, F.aggregate(parts, start, step, lambda s: s["before"]), inside))
        return F.when(F.size(all_numbers) > 0, F.flatten(with_bases)).otherwise(F.array().cast("array<bigint>"))

    return _bound(numbers, blocked)


def loss_spans(parts: Column, role: str = "assistant") -> Column:
    """Code point spans (start, length) of the texts of one role, from the pieces of a formatted string."""
    around = len(OPEN) + len(CLOSE) + 1

    def span(body, before):
        name = F.length(_role(body)) + 2
        return F.struct(
            (before + len(OPEN) + name).cast("int").alias("start"),
            (F.length(body) - name - 1).alias("length"),
            (unescape_role(_role(body)) == role).alias("wanted"),
        )

    def spans(bodies):
        before = sums_before(F.transform(bodies, lambda body: (F.length(body) + around).cast("long")))
        wanted = F.filter(F.zip_with(bodies, before, span), lambda s: s["wanted"])
        return F.transform(wanted, lambda s: F.struct(s["start"], s["length"]))

    return _bound(_bodies(parts), spans)


def texts_at(text: Column, spans: Column) -> Column:
    """The parts of a text at its spans; each is looked up in the few blocks it lies in."""
    # Blocks of equally many code points.
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{TEXT_BLOCK}}}"), F.lit(0))

    def part(s, cut):
        first = F.floor(s["start"] / TEXT_BLOCK).cast("int")
        last = F.floor((s["start"] + F.greatest(s["length"], F.lit(1)) - 1) / TEXT_BLOCK).cast("int")
        around = F.array_join(F.slice(cut, first + 1, last - first + 1), "")
        return F.substring(around, s["start"] - first * TEXT_BLOCK + 1, s["length"])

    return _bound(blocks, lambda cut: F.transform(spans, lambda s: part(s, cut)))


def format_conversations(
    df: DataFrame, conv="conv_id", turn="turn", role="role", text="text", loss_role="assistant"
) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans, escaped.

    Turns are ordered by turn (nulls first), then role, then text; repeated rows stay. A null text
    or role counts as empty, rows with a null conv_id form a conversation of their own. Other
    columns are ignored; an empty table gives no rows. One shuffle by conversation: a formatted
    conversation is one string, so a conversation is the unit of work, and one (null ids together)
    can hold what fits a task: at most 2 GB, Spark's limit of a string. Work grows with the length of a conversation
    and of its texts, not with their squares.
    """
    clean = df.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    source = clean.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")).select(
        "conv_id",
        F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
    )
    # One column per step: each is used more than once, and Spark keeps it for that.
    plain = source.withColumn("plain", render(F.col("turns"), lambda t: t)).withColumn("parts", pieces(F.col("plain")))
    tried = plain.withColumn("escaped", ~parse(F.col("parts")).eqNullSafe(F.col("turns")))
    # Only conversations that didn't come back are rendered and parsed a second time.
    again = F.when(F.col("escaped"), render(F.col("turns"), escape_text))
    retried = tried.withColumn("again", again).withColumn("parts_again", pieces(F.col("again")))
    identical = ~F.col("escaped") | parse(F.col("parts_again")).eqNullSafe(F.col("turns"))
    failed = F.raise_error(F.concat(F.lit("no round trip: "), F.col("conv_id").cast("string")))
    formatted = F.when(~identical, failed.cast("string")).otherwise(F.coalesce("again", "plain"))
    return retried.select(
        "conv_id",
        formatted.alias("formatted"),
        "escaped",
        loss_spans(F.coalesce("parts_again", "parts"), loss_role).alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted strings say: turns by the parser, loss text by the mask."""
    parts = formatted.withColumn("parts", pieces(F.col("formatted")))
    turns = parts.withColumn("turns", parse(F.col("parts")))
    each = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.transform(texts_at(F.col("formatted"), F.col("loss_spans")), unescape_text)
    return turns.withColumn("loss", F.array_join(masked, "")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(each, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
