"""Problem 5: rows that fail to parse, apart from the valid ones and with the reason.

Each payload is first read permissively under an explicit schema with
``from_csv``, which keeps the raw text of what it can't read. A line that the
reader takes whole, without a double quote or line break on which it is more
lenient than the format, is sound and is only cast. Corrupt lines and those
with such marks are classified anew by quoting and column count, and only they
pay for that. Cast checks follow for both. Everything is a JVM expression in a
single scan without shuffle; the scans over a payload are linear in its
length, so a text of megabytes neither overflows a regex stack nor slows down
quadratically.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Separators read with from_csv; a file with another separator is split by the same rules here.
SEPARATORS = (";", "|", "\t", ",")

#: Columns up to which a line is handed to the reader, whose own limit would end the query; a longer line is corrupt anyway.
READER_COLUMNS = 20_000

_BREAK = "\u0001"

# The patterns of an amount, a share and a time stamp.
_DIGITS = r"(?:[0-9]+|[0-9]{1,3}(?:\.[0-9]{3})+)"
AMOUNT = rf"^(?:-|-?{_DIGITS}|\(\s*{_DIGITS}\s*\))?$"
_DECIMAL = rf"{_DIGITS}(?:,[0-9]+)?"
RAW_VALUE = rf"^(?:-|(?:M?US\$ ?)?(?:-?{_DECIMAL}|\(\s*{_DECIMAL}\s*\)))?$"
SHARE = r"^[0-9]+(?:\.[0-9]+)?$"
STAMP = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?(?:Z|\+00:00)?$"


@dataclass(frozen=True)
class Layout:
    """Names of a record kind's fields in order, and the check of each: ``text``, ``required``, ``amount``, ``share``, ``stamp`` or ``figure``."""

    kind: str
    fields: tuple[tuple[str, str], ...]

    @property
    def names(self) -> list[str]:
        return [n for n, _ in self.fields]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{n}` string" for n in self.names) + ", `_corrupt` string"


LINE_ITEM = Layout(
    "line_item",
    (("concepto", "required"), ("ytd_actual", "amount"), ("ytd_anterior", "amount"), ("quarter_actual", "amount"), ("quarter_anterior", "amount")),
)
SOURCE_INFO = Layout(
    "source_info",
    (
        ("field", "required"), ("source_type", "text"), ("file_path", "text"), ("location", "text"),
        ("extraction_method", "text"), ("confidence", "share"), ("timestamp", "stamp"), ("raw_value", "figure"),
    ),
)
LAYOUTS = (LINE_ITEM, SOURCE_INFO)


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def real_stamp(c: Column) -> Column:
    """A UTC time stamp, null unless the text has the pattern and names a real moment."""
    plain = F.regexp_replace(c, r"(?:Z|\+00:00)$", "")
    parsed = F.try_to_timestamp(F.regexp_replace(plain, r"\.[0-9]+$", ""), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    micros = F.rpad(F.regexp_extract(plain, r"\.([0-9]+)$", 1), 6, "0").try_cast("long")
    return F.when(c.rlike(STAMP) & parsed.isNotNull(), F.timestamp_micros(F.unix_micros(parsed) + F.coalesce(micros, F.lit(0))))


def check(c: Column, how: str) -> Column:
    """Whether a field, outer blanks ignored, is valid."""
    v = trimmed(c)
    if how == "required":
        return v != ""
    if how == "amount":
        return v.rlike(AMOUNT)
    if how == "figure":
        return v.rlike(RAW_VALUE)
    if how == "share":
        return v.rlike(SHARE) & F.coalesce(v.try_cast("double").between(0, 1), F.lit(False))
    if how == "stamp":
        return real_stamp(v).isNotNull()
    return F.lit(True)


def to_number(c: Column) -> Column:
    """The number of an amount or figure that passed its check; empty and ``-`` give null."""
    v = F.regexp_replace(trimmed(c), r"^M?US\$ ?", "")
    plain = F.replace(F.regexp_replace(v, r"[.()\s]", ""), F.lit(","), F.lit("."))
    number = plain.try_cast("decimal(38,6)")
    return F.when(v.startswith("("), -number).otherwise(number)


def _outside(parts: Column) -> Column:
    """Parts of a text split at double quotes: those at even places stand outside quotes."""
    return F.filter(parts, lambda _, i: i % 2 == 0)


def quoting_ok(parts: Column, sep: Column) -> Column:
    """Quotes pair up, and open and close only at a field's very first and last character.

    ``parts`` is the payload split at double quotes. An empty part between two
    quoted ones is a doubled quote.
    """
    last = F.size(parts) - 1
    fine = F.forall(
        F.transform(parts, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
        lambda p: (p["i"] % 2 == 1)
        | (p["x"] == "")
        | (((p["i"] == 0) | F.startswith(p["x"], sep)) & ((p["i"] == last) | F.endswith(p["x"], sep))),
    )
    return (F.size(parts) % 2 == 1) & fine


def _read(text: Column, mark: Column, layout: Layout) -> Column:
    """The line as the permissive reader takes it, by its separator; null where the reader doesn't know the separator."""
    read = None
    for s in SEPARATORS:
        options = {"sep": s, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "quote": '"', "escape": '"', "nullValue": "", "emptyValue": "", "maxCharsPerColumn": "-1"}
        one = F.from_csv(text, layout.ddl, options)
        read = F.when(mark == s, one) if read is None else read.when(mark == s, one)
    return read


def _of_reader(layout: Layout) -> Column:
    return F.col(f"__read_{layout.kind}")


def classify(df: DataFrame, payload: str = "payload", sep: str = "sep", kind: str = "record_kind", layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``df`` with ``parsed_<kind>`` structs of text fields, ``_corrupt`` and ``reason``.

    ``reason`` is null for a valid line, else the first that applies of
    ``column_count`` (null or blank payload), ``quoting``, ``column_count``,
    ``value``. A null or empty separator means that the line is one field; an
    unknown or null kind has no layout and counts as ``column_count``. The raw
    text of an invalid line is kept in ``_corrupt``. Input columns named like
    the added ones are replaced.
    """
    text, mark = F.col(payload), F.coalesce(F.col(sep), F.lit(""))
    blank = text.isNull() | ~F.coalesce(text.rlike(r"(?U)\S"), F.lit(False))
    columns = F.length(text) - F.length(F.replace(text, mark, F.lit("")))
    ours = {lay.kind: F.coalesce(F.col(kind) == lay.kind, F.lit(False)) for lay in layouts}
    broken = F.coalesce(text.rlike(r"[\r\n]"), F.lit(False))
    df = df.withColumns({"__blank": blank, "__lenient": broken | F.coalesce(text.contains('"'), F.lit(False))} | {f"__read_{lay.kind}": F.when(ours[lay.kind] & ~blank & (columns < READER_COLUMNS), _read(text, mark, lay)) for lay in layouts})
    whole = {lay.kind: _of_reader(lay).isNotNull() & _of_reader(lay)["_corrupt"].isNull() for lay in layouts}
    sound = ~F.col("__lenient") & F.coalesce(*[F.when(ours[lay.kind], whole[lay.kind]) for lay in layouts], F.lit(False))
    # what the reader didn't settle is taken apart at its quotes and, outside them, at its separators
    clean = F.translate(text, _BREAK, " ")
    apart = F.transform(F.split(clean, '"', -1), lambda x, i: F.when((i % 2 == 0) & (mark != ""), F.replace(x, mark, F.lit(_BREAK))).otherwise(x))
    df = df.withColumn("__sound", sound)
    df = df.withColumns({
        "__quoted": F.when(F.col("__sound"), True).otherwise(F.coalesce(quoting_ok(F.split(text, '"', -1), mark), F.lit(False))),
        "__fields": F.when(~F.col("__sound"), F.split(F.array_join(apart, '"'), _BREAK, -1)),
    })
    unquoted = lambda f: F.when(f.startswith('"'), F.replace(F.substr(f, F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"'))).otherwise(f)
    loaded = {}
    for lay in layouts:
        here = F.struct(*[unquoted(F.get("__fields", F.lit(i))).alias(n) for i, n in enumerate(lay.names)], F.lit(None).cast("string").alias("_corrupt"))
        again = F.when(~F.col("__blank") & F.col("__quoted") & (F.size("__fields") == len(lay.fields)), F.when(whole[lay.kind] & ~broken, _of_reader(lay)).otherwise(here))
        loaded[f"parsed_{lay.kind}"] = F.when(ours[lay.kind], F.when(F.col("__sound"), _of_reader(lay)).otherwise(again))
    df = df.withColumns(loaded)
    reasons = []
    for lay in layouts:
        record = F.col(f"parsed_{lay.kind}")
        fine = F.lit(True)
        for n, how in lay.fields:
            fine = fine & F.coalesce(check(F.coalesce(record[n], F.lit("")), how), F.lit(False))
        reasons.append(F.when(ours[lay.kind], F.when(record.isNull(), "column_count").when(~fine, "value").otherwise("")))
    known = F.coalesce(*reasons, F.lit("column_count"))
    reason = F.nullif(F.when(F.col("__blank"), "column_count").when(~F.col("__quoted"), "quoting").otherwise(known), F.lit(""))
    df = df.withColumn("reason", reason).withColumn("_corrupt", F.when(F.col("reason").isNotNull(), text))
    return df.drop("__blank", "__lenient", "__sound", "__quoted", "__fields", *[f"__read_{lay.kind}" for lay in layouts])


def invalid_rows(classified: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` and ``reason`` of the lines that aren't valid.

    The reason is exploded rather than filtered on: a filter would be pushed
    below the projections and evaluate the parsed records once per use.
    """
    return classified.select(*keep, F.explode(F.when(F.col("reason").isNotNull(), F.array("reason"))).alias("reason"))


def valid_rows(classified: DataFrame, layout: Layout, keep: list[str]) -> DataFrame:
    """The valid lines of one kind as typed rows."""
    record = F.col(f"parsed_{layout.kind}")
    fine = classified.select(*keep, F.explode(F.when(F.col("reason").isNull() & record.isNotNull(), F.array(record))).alias("__r"))
    typed = []
    for n, how in layout.fields:
        v = trimmed(F.col(f"__r.{n}"))
        e = {"amount": to_number(v).cast("long"), "figure": to_number(v).cast("double"), "share": v.try_cast("double"), "stamp": real_stamp(v)}.get(how, F.nullif(v, F.lit("")))
        typed.append(e.alias(n))
    return fine.select(*keep, *typed)
