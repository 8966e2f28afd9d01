r"""Chat formatting in budgeted windows, with DataFrame operations only.

A turn is written ``### Role:`` (line feed) text (line feed) ``</turn>`` (line feed). Backslashes,
number signs and opening brackets inside texts and roles are escaped, so that neither control string
can occur in them, and reading back is exact.

Prefix sums of turn tokens place each turn in a span: turns end in the same half budget, and a turn
above half of it is a span of its own. The budget of spans is what system turn and history leave of the whole,
so a window, which is a span after the system turn and as much earlier history as fits its share, keeps
to the budget. Repeated turns carry no loss: every assistant text is a target in
exactly one window.

Turns are ordered by ``turn``, then role and text; nulls come first, and null texts and roles are
empty. Rows with a null conversation are one conversation. Repeated rows are turns of their own. A
turn longer than the budget of spans keeps its whole text in a window of its own, which may exceed the budget; if
the system turn leaves no room at all, every turn has a window to itself. An empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD, query, table
from millrace.session import materialize

HEAD, MIDDLE, CLOSE = "### ", ":\n", "\n</turn>\n"
ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
OVERHEAD = 4  # tokens of a turn's marks
TARGET_ROLE, SYSTEM_ROLE = "assistant", "system"


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def _title(role: Column) -> Column:
    """Roles are shown with a capital; the rest is as it is, and other roles are quoted to keep them apart."""
    known = F.create_map(*[F.lit(x) for r in ("system", "user", "assistant") for x in (r, r.capitalize())])
    return F.coalesce(F.element_at(known, role), F.concat(F.lit("="), F.replace(escape(role), F.lit("\n"), F.lit("\\e"))))


def _role(title: Column) -> Column:
    quoted = unescape(F.replace(F.substring(title, 2, 1 << 30), F.lit("\\e"), F.lit("\n")))
    return F.when(title.startswith("="), quoted).otherwise(F.lower(title))


def windows(
    turns: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    budget: int = 1024,
    history: int = 256,
) -> DataFrame:
    """``conv_id, window, context_turns, new_turns, tokens, text, loss_spans`` for each window.

    ``context_turns`` counts the repeated turns at the start; ``loss_spans`` are structs of 1-based
    character ``start`` and ``length``.
    """
    rows = turns.select(
        F.col(conv_id).alias("_conv"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit("")).alias("_role"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    rows = rows.withColumn("_tokens", (F.regexp_count("_text", F.lit(WORD)) + OVERHEAD).cast("long"))
    order = Window.partitionBy("_conv").orderBy("_turn", "_role", "_text")
    placed = rows.withColumns(
        {"_at": F.row_number().over(order), "_upto": F.sum("_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))}
    )
    placed = placed.withColumn("_before", F.col("_upto") - F.col("_tokens"))
    # A conversation's system turn is its first turn, if that has the role. It stands in every window.
    leading = (F.col("_at") == 1) & (F.col("_role") == SYSTEM_ROLE)
    system = F.max(F.when(leading, F.struct("_role", "_text", "_tokens"))).over(Window.partitionBy("_conv"))
    placed = placed.withColumn("_system", system)
    room = budget - history - F.coalesce(F.col("_system._tokens"), F.lit(0))
    half = F.greatest(F.floor(room / 2), F.lit(1))
    large = (F.col("_tokens") > half).cast("int")
    by_place = Window.partitionBy("_conv").orderBy("_at")
    placed = placed.withColumn("_large", F.sum(large).over(by_place))
    grid = F.struct("_large", (1 - large).alias("small"), F.when(large == 1, F.lit(0)).otherwise(F.floor((F.col("_upto") - 1) / half)).alias("cell"))
    placed = placed.withColumn("_grid", grid)
    fresh = F.coalesce(F.col("_grid") != F.lag("_grid").over(by_place), F.lit(True))
    placed = placed.withColumn("_fresh", fresh)
    placed = placed.withColumn("_span", F.sum(F.col("_fresh").cast("int")).over(by_place))
    recent = Window.partitionBy("_conv").orderBy("_before").rangeBetween(-history, -1)
    spare = F.collect_list(F.when(~leading, F.struct("_at", "_role", "_text", "_tokens"))).over(recent)
    # Only the first turn of a span needs its history.
    placed = placed.withColumn("_past", F.when(F.col("_fresh"), spare))
    whole = F.collect_list(F.struct("_at", "_role", "_text", "_tokens"))
    spans = placed.groupBy("_conv", "_span").agg(
        F.array_sort(whole).alias("_new"), F.first("_past", ignorenulls=True).alias("_past"), F.first("_system").alias("_system")
    )
    has_system = F.col("_system").isNotNull() & (F.col("_new")[0]["_at"] > 1)
    lead = F.when(has_system, F.array(F.struct(F.lit(1).alias("_at"), F.col("_system._role").alias("_role"), F.col("_system._text").alias("_text"), F.col("_system._tokens").alias("_tokens")))).otherwise(F.expr("array()"))
    spans = spans.withColumn("_context", F.concat(lead, F.array_sort(F.coalesce("_past", F.expr("array()")))))

    def shown(item: Column) -> Column:
        return F.concat(F.lit(HEAD), _title(item["_role"]), F.lit(MIDDLE), escape(item["_text"]), F.lit(CLOSE))

    spans = spans.withColumns(
        {
            "_before": F.array_join(F.transform("_context", shown), ""),
            "_parts": F.transform("_new", shown),
            "_roles": F.transform("_new", lambda t: t["_role"] == TARGET_ROLE),
            "_heads": F.transform("_new", lambda t: F.length(F.concat(F.lit(HEAD), _title(t["_role"]), F.lit(MIDDLE)))),
        }
    )
    # Offsets are prefix sums of lengths; spans are short, so an aggregate over their parts is too.
    zipped = F.arrays_zip("_parts", "_roles", "_heads")
    start = F.struct(F.length("_before").alias("at"), F.expr("cast(array() AS array<struct<start:int,length:int>>)").alias("spans"))

    def step(state, part):
        size = F.length(part["_parts"])
        span = F.struct((state["at"] + part["_heads"] + 1).alias("start"), (size - part["_heads"] - len(CLOSE)).alias("length"))
        longer = F.when(part["_roles"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + size).alias("at"), longer.alias("spans"))

    tokens = F.aggregate(F.concat(F.transform("_context", lambda t: t["_tokens"]), F.transform("_new", lambda t: t["_tokens"])), F.lit(0).cast("long"), lambda a, x: a + x)
    return spans.select(
        F.col("_conv").alias(conv_id),
        F.col("_span").alias("window"),
        F.size("_context").alias("context_turns"),
        F.size("_new").alias("new_turns"),
        tokens.alias("tokens"),
        F.concat("_before", F.array_join("_parts", "")).alias("text"),
        F.aggregate(zipped, start, step, lambda s: s["spans"]).alias("loss_spans"),
    )


def read_turns(formatted: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """``conv_id, window, turns`` (structs of role and text, repeated ones left out) and ``targets``."""
    parts = F.split(F.col("text"), CLOSE.replace("/", "\\/"))
    fresh = F.slice(parts, F.col("context_turns") + 1, F.col("new_turns"))

    def turn_of(part: Column) -> Column:
        head = F.substring_index(part, MIDDLE, 1)
        text = part.substr(F.length(head) + 1 + len(MIDDLE), F.length(part))
        return F.struct(_role(F.substring(head, len(HEAD) + 1, 1 << 30)).alias("role"), unescape(text).alias("text"))

    def target(span: Column) -> Column:
        return unescape(F.substring(F.col("text"), span["start"], span["length"]))

    return formatted.select(
        conv_id, "window", F.length("text").alias("chars"), F.transform(fresh, turn_of).alias("turns"),
        F.transform("loss_spans", target).alias("targets"),
    )


@query("op6_chat_windows")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of what the windows give back. The windows are written out and read as a user would."""
    said = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    formatted = materialize(windows(given.unionByName(extra)), "windows")
    back = read_turns(formatted)
    pieces = F.array_sort(F.collect_list(F.struct("window", "turns", "targets")))
    joined = back.groupBy("conv_id").agg(pieces.alias("_all"), F.sum("chars").alias("formatted_chars"))
    turns = F.flatten(F.transform("_all", lambda w: w["turns"]))
    targets = F.array_join(F.flatten(F.transform("_all", lambda w: w["targets"])), "")
    shown = F.array_join(F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return joined.withColumns({"_turns": turns, "_targets": targets}).select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(shown.cast("binary"), 256).alias("turns_sha256"),
        F.length("_targets").cast("long").alias("loss_chars"),
        F.sha2(F.col("_targets").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
