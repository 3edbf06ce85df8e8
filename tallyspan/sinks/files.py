"""Sinks: JSON records by period, CSV, provenance, audits and workbooks; and the readers of what they write."""

from __future__ import annotations

import io
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from itertools import chain, islice
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a workbook sheet; large results belong in CSV or parquet.
WORKBOOK_ROWS = 100_000


def write_records(df: DataFrame, path: str, by: tuple[str, ...] = ("year", "quarter")) -> None:
    """JSON lines, a folder per period; rewriting a period replaces only its own folder."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)


def wrapped_records(df: DataFrame, sheet: str, year: str, quarter: str, columns: list[str]) -> DataFrame:
    """``(file_name, content)`` of wrapped sheet records: the name, period and figures of a row as one JSON text."""
    from tallyspan.functions.periods import format_period

    key = format_period(F.col(year), F.col(quarter))
    body = F.struct(F.col(sheet).alias("sheet_name"), F.col(year).alias("year"), F.col(quarter).alias("quarter"), key.alias("period"), F.struct(*columns).alias("content"))
    return df.select(F.concat(F.col(sheet), F.lit("_"), key, F.lit(".json")).alias("file_name"), F.to_json(body, {"ignoreNullFields": "false"}).alias("content"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def write_provenance(sources: DataFrame, path: str, period: str = "period") -> None:
    """Sources as JSON lines, one per source with all its columns, in a folder per period. Nothing is gathered, so a period may be of any size."""
    sources.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", "false").partitionBy(period).json(path)


def read_provenance(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """What write_provenance wrote, time stamps included. ``schema`` names the columns, the period among them."""
    return spark.read.schema(schema).json(path)


def read_provenance_maps(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """``(file, field, ord, ...)`` of provenance files that each hold one object of fields to lists of sources; ``columns`` are the fields of a source. A file that is no such object yields none."""
    texts = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.from_json("value", f"map<string, array<struct<{columns}>>>").alias("m"))
    return texts.select("file", F.explode("m").alias("field", "s")).select("file", "field", F.posexplode("s").alias("ord", "s")).select("file", "field", "ord", "s.*")


def append_audit(rows: DataFrame, path: str) -> None:
    """Audit rows, such as the calls of an OCR service, added to a parquet table in a folder per day of ``at``."""
    rows.withColumn("day", F.to_date("at")).write.mode("append").partitionBy("day").parquet(path)


def _cell(ref: str, v: object) -> str:
    if v is None:
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{v}</v></c>'
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'


def _column(i: int) -> str:
    out = ""
    i += 1
    while i:
        i, r = divmod(i - 1, 26)
        out = chr(65 + r) + out
    return out


def sheet_names(names: Sequence[str]) -> list[str]:
    """Names cut to 31 characters, those that clash then (case aside) numbered."""
    taken, out = set(), []
    for name in names:
        short, n = name[:31], 1
        while short.lower() in taken:
            n += 1
            mark = f" ({n})"
            short = name[: 31 - len(mark)] + mark
        taken.add(short.lower())
        out.append(short)
    return out


def write_workbook(sheets: Mapping[str, DataFrame], path: str, most: int = WORKBOOK_ROWS) -> None:
    """An Office Open XML workbook for people, written by the driver one row at a time: an entry of more than ``most`` rows goes on in further sheets of its name; nothing is cut off. Names are made as sheet_names says."""
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    package = "http://schemas.openxmlformats.org/package/2006"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        wanted: list[str] = []
        for name, df in sheets.items():
            rows = df.toLocalIterator()
            more = True
            while more:
                wanted.append(name)
                with z.open(f"xl/worksheets/sheet{len(wanted)}.xml", "w") as f:
                    f.write(f'{head}<worksheet xmlns="{main}"><sheetData>'.encode())
                    n = 0
                    for n, line in enumerate(chain([df.columns], islice(rows, most)), 1):
                        f.write((f'<row r="{n}">' + "".join(_cell(f"{_column(j)}{n}", v) for j, v in enumerate(line)) + "</row>").encode())
                    f.write(b"</sheetData></worksheet>")
                ahead = next(rows, None) if n > most else None
                more, rows = ahead is not None, rows if ahead is None else chain([ahead], rows)
        names = sheet_names(wanted)
        listed = "".join(f'<sheet name="{escape(s)}" sheetId="{i}" r:id="rId{i}"/>' for i, s in enumerate(names, 1))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{listed}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{package}/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1)) + "</Relationships>")
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, len(names) + 1)) + "</Types>")


def workbook_rows(data: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """``(sheet, row number, cells)`` of a workbook in order, cells as text, gaps null."""
    local = lambda e: e.tag.rpartition("}")[2]
    text = lambda e: "".join(t.text or "" for t in e.iter() if local(t) == "t")
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        shared = [text(e) for e in ET.fromstring(z.read("xl/sharedStrings.xml")) if local(e) == "si"] if "xl/sharedStrings.xml" in z.namelist() else []
        targets = {e.get("Id"): e.get("Target", "") for e in ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for sheet in (e for e in ET.fromstring(z.read("xl/workbook.xml")).iter() if local(e) == "sheet"):
            target = targets[next(v for k, v in sheet.attrib.items() if k.rpartition("}")[2] == "id" and k != "id")].lstrip("/")
            for row in (e for e in ET.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}")).iter() if local(e) == "row"):
                cells: list[str | None] = []
                for c in row:
                    letters = re.match(r"[A-Z]*", c.get("r", ""))[0]
                    at = len(cells)
                    if letters:
                        at = 0
                        for x in letters:
                            at = at * 26 + ord(x) - 64
                        at -= 1
                    cells += [None] * (at - len(cells))
                    value = next((e.text for e in c if local(e) == "v"), None)
                    kind = c.get("t")
                    cells.append(text(c) if kind == "inlineStr" else shared[int(value)] if kind == "s" and value is not None else value)
                yield sheet.get("name", ""), int(row.get("r", "0")), cells


def read_workbooks(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    """``(file, sheet, row_no, cells)`` of all workbooks under a path, a task per file; what is no workbook yields none."""
    from tallyspan.session import ship_package

    ship_package(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"), "content")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for file, data in zip(batch["file"], batch["content"]):
                try:
                    rows += [(file, *r) for r in workbook_rows(bytes(data))]
                except (zipfile.BadZipFile, KeyError, ET.ParseError):
                    continue
            yield pd.DataFrame(rows, columns=["file", "sheet", "row_no", "cells"])

    return files.mapInPandas(run, "file string, sheet string, row_no int, cells array<string>")


def workbook_values(rows: DataFrame, lead: int = 2) -> DataFrame:
    """``(file, sheet, label, period, value)`` of period matrices read from workbooks: the first row names the periods after ``lead`` leading columns, the last of which is the label."""
    heads = rows.where("row_no = 1").select("file", "sheet", F.slice("cells", lead + 1, F.greatest(F.lit(1), F.size("cells"))).alias("periods"))
    body = rows.where("row_no > 1").select("file", "sheet", F.get("cells", F.lit(lead - 1)).alias("label"), F.slice("cells", lead + 1, F.greatest(F.lit(1), F.size("cells"))).alias("v"))
    pairs = body.join(heads, ["file", "sheet"]).select("file", "sheet", "label", F.explode(F.arrays_zip("periods", "v")).alias("p"))
    return pairs.where("p.periods is not null").select("file", "sheet", "label", F.col("p.periods").alias("period"), F.col("p.v").try_cast("double").alias("value"))


def workbook_periods(rows: DataFrame, lead: int = 2) -> DataFrame:
    """``(file, sheet, period)``: the periods that workbooks hold already."""
    return rows.where("row_no = 1").select("file", "sheet", F.explode(F.slice("cells", lead + 1, F.greatest(F.lit(1), F.size("cells")))).alias("period")).where("period is not null")
