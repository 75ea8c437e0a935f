"""Chat records of many layouts as canonical turns, and turns as marked training text.

A record is a VARIANT. Which of the declared field paths it has, hashed, is its fingerprint; a
fingerprint selects the layout, and with it the declarative mapping to turns. Everything is column
expressions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Turns gathered into one row before a conversation's rows meet.
TURNS_PER_CHUNK = 256


@dataclass(frozen=True)
class Layout:
    """Field paths every record of a layout has, those it may have, and its turns: an array of
    (place, role, text) made of the record by ``turns``. ``place`` is null where the array's order
    is the turns' order."""

    name: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    turns: Callable[[Column], Column]


def _text(record: Column, path: str) -> Column:
    return F.try_variant_get(record, path, "string")


def _turn(role: Column, text: Column, place: Column | None = None) -> Column:
    where = place if place is not None else F.lit(None)
    return F.struct(where.cast("long").alias("place"), role.cast("string").alias("role"), text.cast("string").alias("text"))


def _said(role: str, text: Column) -> Column:
    """A turn if the record has the text, else null."""
    return F.when(text.isNotNull(), _turn(F.lit(role), text))


def _messages(path: str, role: str, text: str) -> Callable[[Column], Column]:
    def turns(record: Column) -> Column:
        found = F.try_variant_get(record, path, f"array<struct<{role}: string, {text}: string>>")
        return F.transform(found, lambda m: _turn(m[role], m[text]))

    return turns


def _named(names: dict[str, str], turns: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """Turns with other names for their roles."""

    def renamed(record: Column) -> Column:
        role = lambda t: F.coalesce(*(F.when(t["role"] == a, F.lit(b)) for a, b in names.items()), t["role"])
        return F.transform(turns(record), lambda t: _turn(role(t), t["text"], t["place"]))

    return renamed


def _instruction(record: Column) -> Column:
    asked, more = _text(record, "$.instruction"), _text(record, "$.input")
    asked = F.concat_ws("\n\n", asked, F.when(more != "", more))
    return F.array_compact(F.array(_said("system", _text(record, "$.system")), _said("user", asked), _said("assistant", _text(record, "$.output"))))


def _prompt(answer: str) -> Callable[[Column], Column]:
    def turns(record: Column) -> Column:
        return F.array_compact(
            F.array(_said("system", _text(record, "$.system")), _said("user", _text(record, "$.prompt")), _said("assistant", _text(record, answer)))
        )

    return turns


LAYOUTS = (
    Layout("turn rows", ("$.turn", "$.role", "$.text"), (), lambda r: F.array(_turn(_text(r, "$.role"), _text(r, "$.text"), F.try_variant_get(r, "$.turn", "long")))),
    Layout("messages", ("$.messages", "$.messages[0].role", "$.messages[0].content"), (), _messages("$.messages", "role", "content")),
    Layout(
        "conversations", ("$.conversations", "$.conversations[0].from", "$.conversations[0].value"), ("$.system",),
        _named({"human": "user", "gpt": "assistant", "bot": "assistant"}, lambda r: F.concat(
            F.array_compact(F.array(_said("system", _text(r, "$.system")))), _messages("$.conversations", "from", "value")(r))),
    ),
    Layout("instruction", ("$.instruction", "$.output"), ("$.input", "$.system"), _instruction),
    Layout("prompt and completion", ("$.prompt", "$.completion"), ("$.system",), _prompt("$.completion")),
    Layout("prompt and response", ("$.prompt", "$.response"), ("$.system",), _prompt("$.response")),
)


def paths_of(layouts: Sequence[Layout]) -> list[str]:
    return sorted({p for layout in layouts for p in (*layout.required, *layout.optional)})


def _print_of(present: Column) -> Column:
    return F.xxhash64(F.array_join(present, "\n"))


def fingerprint(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Hash of the declared field paths the record has; a field with a JSON null counts as there,
    undeclared fields do not matter."""
    return _print_of(F.array_compact(F.array(*(F.when(F.try_variant_get(record, p, "variant").isNotNull(), F.lit(p)) for p in paths_of(layouts)))))


def layout_of(record: Column, layouts: Sequence[Layout] = LAYOUTS) -> Column:
    """Name of the layout whose fingerprints (one for each choice of optional paths) hold the
    record's; null if none does."""
    found = fingerprint(record, layouts)
    name = F.lit(None).cast("string")
    for layout in layouts:
        sets = [sorted((*layout.required, *extra)) for n in range(len(layout.optional) + 1) for extra in combinations(layout.optional, n)]
        prints = [_print_of(F.array(*(F.lit(p) for p in paths))) for paths in sets]
        name = F.when(found.isin(*prints), F.lit(layout.name)).otherwise(name)
    return name


def canonical_turns(records: DataFrame, conv_id: str = "conv_id", record: str = "record", layouts: Sequence[Layout] = LAYOUTS) -> DataFrame:
    """conv_id, layout, place, role, text: the turns of all records, a record's turns in order.

    A record of no declared layout, or a null one, gives one row with null layout, role and text, so
    none is lost. ``place`` is the turn's number in the record, or what the record says it is."""
    named = records.select(F.col(conv_id).cast("long").alias("conv_id"), layout_of(F.col(record), layouts).alias("layout"), F.col(record).alias("record"))
    turns = F.lit(None)
    for layout in layouts:
        turns = F.when(F.col("layout") == layout.name, layout.turns(F.col("record"))).otherwise(turns)
    found = named.select("conv_id", "layout", F.posexplode_outer(turns).alias("at", "turn"))
    return found.select("conv_id", "layout", F.coalesce("turn.place", F.col("at").cast("long")).alias("place"), "turn.role", "turn.text")


def escaped(text: Column) -> Column:
    """Text without a control string or a bare backslash: reversible, as every backslash left leads
    a code of one letter."""
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")), F.lit("<|"), F.lit("\\l"))


def _escaped_text(text: Column) -> Column:
    """The same, with line feeds as they are."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("\\l"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\l"), F.lit("<|")), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def formatted(turns: DataFrame, trained: Sequence[str] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv_id and segments, an array of (text, loss) in order.

    The segments' texts in a row are the formatted conversation: each turn is START, role, line
    feed, text, END, line feed, with roles and texts escaped. Loss marks the texts of the roles to
    train on. Turns are ordered by place, role, text; a null role or text is empty. A long
    conversation is gathered in chunks of places before its chunks meet."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
    pieces = F.array(
        part(F.concat(F.lit(START), escaped(role), F.lit("\n")), F.lit(False)),
        part(_escaped_text(text), role.isin(*trained)),
        part(F.lit(f"{END}\n"), F.lit(False)),
    )
    rows = turns.select(
        "conv_id", F.struct(F.col("place"), role.alias("role"), text.alias("text"), pieces.alias("pieces")).alias("turn"),
        F.floor(F.col("place") / TURNS_PER_CHUNK).alias("chunk"),
    )
    chunks = rows.groupBy("conv_id", "chunk").agg(F.flatten(F.transform(F.sort_array(F.collect_list("turn")), lambda t: t["pieces"])).alias("segments"))
    whole = chunks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "segments"))).alias("chunks"))
    return whole.select("conv_id", F.flatten(F.transform("chunks", lambda c: c["segments"])).alias("segments"))


def text_of(segments: Column | str) -> Column:
    """The formatted conversation."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def turns_in(text: Column) -> Column:
    """Array of (role, text), read back from a formatted conversation."""
    marked = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda t: t != "")
    head = lambda t: F.substring_index(t, "\n", 1)
    return F.transform(
        marked,
        lambda t: F.struct(
            unescaped(F.substr(head(t), F.lit(len(START) + 1))).alias("role"), unescaped(F.substr(t, F.length(head(t)) + 2)).alias("text")
        ),
    )


def loss_text(segments: Column | str) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")
