"""Sources: tagged XML filings, zip archives of them, page texts, HTML link lists, and JSON sheets.

Files are read as ``binaryFile`` rows, so any file system Spark reaches will
do and one task handles one file at a time; what a file yields is numbered in
document order.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import time
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Callable, Collection, Iterable, Iterator, Mapping
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions.keys import period_quarter, period_year
from tallyspan.session import ship_package
from tallyspan.sources.tables import broadcast_if_small

FACTS = "doc_id string, fact_ord int, name string, namespace string, value string, context_ref string, unit_ref string, decimals string"
CONTEXTS = "doc_id string, ctx_ord int, ctx_id string, period_type string, instant string, start_date string, end_date string, entity_id string, entity_scheme string"
ERRORS = "doc_id string, error string"


def parse_xml(data: bytes) -> ET.Element:
    """Root element; bytes that aren't well-formed in their own encoding are read again as ISO-8859-1."""
    try:
        return ET.fromstring(data)
    except ET.ParseError:
        body = data.decode("iso-8859-1")
        return ET.fromstring(body[body.index("?>") + 2 :] if body.lstrip().startswith("<?xml") and "?>" in body else body)


def split_tag(tag: str) -> tuple[str, str]:
    """(namespace, local name)."""
    return tuple(tag[1:].split("}", 1)) if tag.startswith("{") else ("", tag)


def facts_of(root: ET.Element) -> Iterator[tuple]:
    """Every element with a contextRef, in document order."""
    n = 0
    for e in root.iter():
        if isinstance(e.tag, str) and (ref := e.get("contextRef")) is not None:
            space, name = split_tag(e.tag)
            yield n, name, space, e.text, ref, e.get("unitRef"), e.get("decimals")
            n += 1


def contexts_of(root: ET.Element) -> Iterator[tuple]:
    """Contexts with an id: an instant, or start and end; dimensions are ignored."""
    n = 0
    for e in root.iter():
        if isinstance(e.tag, str) and split_tag(e.tag)[1] == "context" and e.get("id"):
            told: dict[str, str | None] = {}
            for x in e.iter():
                name = split_tag(x.tag)[1] if isinstance(x.tag, str) else ""
                if name in ("instant", "startDate", "endDate"):
                    told.setdefault(name, (x.text or "").strip() or None)
                elif name == "identifier":
                    told.setdefault("id", (x.text or "").strip() or None)
                    told.setdefault("scheme", x.get("scheme"))
            kind = "instant" if "instant" in told else "duration" if "startDate" in told or "endDate" in told else None
            yield n, e.get("id"), kind, told.get("instant"), told.get("startDate"), told.get("endDate"), told.get("id"), told.get("scheme")
            n += 1


def filing_member(data: bytes) -> bytes | None:
    """The filing within a zip archive: its first ``.xbrl``, else its first ``.xml`` member; null if there is none."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        for end in (".xbrl", ".xml"):
            for n in names:
                if n.lower().endswith(end):
                    return z.read(n)
    return None


def _documents(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """``(doc_id, content)`` of all files under a path; the id is a file's path below it without the extension, so that files of one name in two folders stay apart."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    base = re.sub(r"^[a-z0-9]+:/*(?=/)", "", path.rstrip("/"))
    plain = F.regexp_replace("path", r"^[a-z0-9]+:/*(?=/)", "")
    below = F.when(plain.startswith(base + "/"), F.substr(plain, F.lit(len(base) + 2), F.length(plain))).otherwise(F.regexp_extract(plain, r"([^/]+)$", 1))
    return files.select(F.regexp_replace(below, r"\.[A-Za-z0-9]{1,5}$", "").alias("doc_id"), "content")


def _per_file(documents: DataFrame, rows_of: Callable[[str, bytes], Iterable[tuple]], schema: str) -> DataFrame:
    """Rows that a function makes of each file, one frame per batch of files."""
    ship_package(documents.sparkSession)
    names = [x.strip().split(" ")[0] for x in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [r for doc, data in zip(batch["doc_id"], batch["content"]) for r in rows_of(doc, bytes(data))]
            yield pd.DataFrame(rows, columns=names)

    return documents.mapInPandas(run, schema)


def _parsed(documents: DataFrame, each, schema: str) -> DataFrame:
    """Rows of ``each(root)`` per document; a broken document yields none (see read_errors). ``each`` None: the errors."""

    def rows_of(doc: str, data: bytes) -> list[tuple]:
        try:
            body = filing_member(data) if data[:2] == b"PK" else data
            if body is None:
                raise ValueError("no filing in the archive")
            root = parse_xml(body)
            return [(doc, *r) for r in each(root)] if each is not None else []
        except (ET.ParseError, zipfile.BadZipFile, ValueError) as e:
            return [(doc, str(e))] if each is None else []

    return _per_file(documents, rows_of, schema)


def namespaces_of(data: bytes) -> dict[str, str]:
    """Prefix to namespace of every declaration in a document, the first of a prefix; the default namespace has the empty prefix."""
    found: dict[str, str] = {}
    for _, (prefix, space) in ET.iterparse(io.BytesIO(data), events=("start-ns",)):
        found.setdefault(prefix or "", space)
    return found


def read_namespaces(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(doc_id, prefix, namespace)`` of all filings under a path; a document that breaks off yields none."""

    def rows_of(doc: str, data: bytes) -> list[tuple]:
        try:
            return [(doc, *x) for x in namespaces_of((filing_member(data) or b"") if data[:2] == b"PK" else data).items()]
        except (ET.ParseError, zipfile.BadZipFile):
            return []

    return _per_file(_documents(spark, path, pattern), rows_of, "doc_id string, prefix string, namespace string")


def read_facts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Facts of all filings under a path, XML or zip."""
    return _parsed(_documents(spark, path, pattern), facts_of, FACTS)


def read_contexts(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    return _parsed(_documents(spark, path, pattern), contexts_of, CONTEXTS)


def read_errors(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Documents that can't be read, with the reason. Files of no bytes yield no rows at all, as the file source skips them."""
    return _parsed(_documents(spark, path, pattern), None, ERRORS)


def xpath_texts(xml: Column, path: str) -> Column:
    """Texts an XPath without prefixes selects in a column of XML, in document order, in the JVM."""
    return F.xpath(xml, F.lit(path))


def xpath_prefixed(df: DataFrame, keep: list[str], xml: str, path: str, namespaces: Mapping[str, str]) -> DataFrame:
    """``keep`` and ``values`` for a path with namespace prefixes (the ElementTree subset)."""
    spaces = dict(namespaces)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema) + ", values array<string>"

    def texts(body: str | None) -> list[str] | None:
        try:
            return None if body is None else [e.text or "" for e in parse_xml(body.encode()).iterfind(path, spaces)]
        except ET.ParseError:
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[keep].assign(values=[texts(b) for b in batch[xml]])

    ship_package(df.sparkSession)
    return df.select(*keep, xml).mapInPandas(run, schema)


def plain_pages(data: bytes) -> list[str]:
    """The pages of a text file, parted by form feeds."""
    return data.decode("utf-8", "replace").split("\f")


def plain_tables(text: str) -> list[list[list[str | None]]]:
    """The tables of a page of plain text: runs of two or more lines whose cells are parted by tabs or by two blanks or more; an empty cell is null."""
    tables: list[list[list[str | None]]] = [[]]
    for line in text.splitlines():
        cells = re.split(r"\t| {2,}", line.strip())
        if len(cells) > 1:
            tables[-1].append([c.strip() or None for c in cells])
        elif tables[-1]:
            tables.append([])
    return [t for t in tables if len(t) > 1]


def read_pages(spark: SparkSession, path: str, extract: Callable[[bytes], Iterable[str]] = plain_pages, pages: Collection[int] | None = None, pattern: str = "*") -> DataFrame:
    """``(doc_id, page_no, text)`` of the files under a path, or of the named pages only. ``extract`` yields a file's page texts."""
    rows_of = lambda doc, data: [(doc, i, t) for i, t in enumerate(extract(data), 1) if pages is None or i in pages]
    return _per_file(_documents(spark, path, pattern), rows_of, "doc_id string, page_no int, text string")


def read_tables(spark: SparkSession, path: str, extract: Callable[[bytes], Iterable[Iterable[list[list[str | None]]]]] | None = None, pages: Collection[int] | None = None, pattern: str = "*") -> DataFrame:
    """``(doc_id, page_no, table_idx, row_idx, cells)``: the table grids of each page. ``extract`` yields, per page of a file, its tables; by default those of plain text."""
    found = extract or (lambda data: [plain_tables(t) for t in plain_pages(data)])

    def rows_of(doc: str, data: bytes) -> Iterator[tuple]:
        for page, tables in enumerate(found(data), 1):
            if pages is None or page in pages:
                for t, rows in enumerate(tables):
                    yield from ((doc, page, t, r, list(cells)) for r, cells in enumerate(rows))

    return _per_file(_documents(spark, path, pattern), rows_of, "doc_id string, page_no int, table_idx int, row_idx int, cells array<string>")


def read_document_info(spark: SparkSession, path: str, describe: Callable[[bytes], Mapping[str, str]] = lambda data: {}, extract: Callable[[bytes], Iterable[str]] = plain_pages, pattern: str = "*") -> DataFrame:
    """``(doc_id, n_bytes, n_pages, sha256, properties)`` of each file; ``describe`` yields its properties."""
    rows_of = lambda doc, data: [(doc, len(data), sum(1 for _ in extract(data)), hashlib.sha256(data).hexdigest(), dict(describe(data)))]
    told = _per_file(_documents(spark, path, pattern), lambda d, b: [(*x[:4], json.dumps(x[4])) for x in rows_of(d, b)], "doc_id string, n_bytes bigint, n_pages int, sha256 string, properties string")
    return told.withColumn("properties", F.from_json("properties", "map<string, string>"))


def link_periods(html: Column) -> Column:
    """Array of ``(href, year, quarter)`` of the links in an HTML text whose address or text holds a date of a quarter's end (``31-03-2024`` or ``2024-03-31``)."""
    links = F.regexp_extract_all(html, F.lit(r"(?is)<a\b[^>]*?href\s*=\s*[\"'][^\"']*[\"'][^>]*>.*?</a>"), F.lit(0))
    # Quarters by their last month.
    quarters = F.create_map(*[F.lit(x) for p in (("03", 1), ("06", 2), ("09", 3), ("12", 4)) for x in p])

    def one(link: Column) -> Column:
        front, back = r"(?<![0-9])[0-9]{1,2}[-/.]([0-9]{2})[-/.]([0-9]{4})", r"(?<![0-9])([0-9]{4})[-/.]([0-9]{2})[-/.][0-9]{2}"
        by_day = link.rlike(front)
        month = F.when(by_day, F.regexp_extract(link, front, 1)).otherwise(F.regexp_extract(link, back, 2))
        year = F.when(by_day, F.regexp_extract(link, front, 2)).otherwise(F.regexp_extract(link, back, 1))
        return F.struct(F.regexp_extract(link, r"(?i)href\s*=\s*[\"']([^\"']*)", 1).alias("href"), year.try_cast("int").alias("year"), F.try_element_at(quarters, month).alias("quarter"))

    return F.filter(F.transform(links, one), lambda x: x["quarter"].isNotNull() & x["year"].isNotNull())


def sheet_files(names: DataFrame, name: str) -> DataFrame:
    """File names that name a sheet and a quarter, with both parsed, in order of sheet, year and quarter."""
    stem = F.regexp_extract(name, r"([^/]+)\.json$", 1)
    sheet = F.regexp_extract(stem, r"^([A-Za-z]+[0-9]*)_", 1)
    rest = F.regexp_replace(stem, r"^[A-Za-z]+[0-9]*_", "")
    parsed = names.withColumns({"sheet_name": sheet, "year": period_year(rest), "quarter": period_quarter(rest)})
    return parsed.where("sheet_name <> '' and year is not null and quarter is not null").orderBy("sheet_name", "year", "quarter", name)


def first_existing(listing: DataFrame, patterns: DataFrame) -> DataFrame:
    """Per period key, the file of the first pattern that exists. ``listing``: key, file; ``patterns`` (small): key, file, rank."""
    from tallyspan.operators.select import pick_first

    return pick_first(listing.join(broadcast_if_small(patterns), ["key", "file"]), ["key"], [F.col("rank")], ["file", "rank"])


def page_periods(pages: DataFrame, keep: list[str], html: str, extract: Callable[[Column], Column] = link_periods) -> DataFrame:
    """``keep``, ``href``, ``year``, ``quarter``: the periods that listing pages offer, newest first within a page's array. ``extract`` turns a page into an array of such structs, one per source of pages."""
    return pages.select(*keep, F.inline(F.array_sort(extract(F.col(html)), lambda a, b: F.when(a["year"] != b["year"], b["year"] - a["year"]).otherwise(b["quarter"] - a["quarter"]))))


def offers_period(pages: DataFrame, keep: list[str], html: str, year: int, quarter: int, extract: Callable[[Column], Column] = link_periods) -> DataFrame:
    """``keep`` and ``available``: whether a listing page offers a period."""
    return pages.select(*keep, F.coalesce(F.exists(extract(F.col(html)), lambda x: (x["year"] == year) & (x["quarter"] == quarter)), F.lit(False)).alias("available"))


def _calls(chain: list, attempts: int, wait: float, longest: float, data: bytes) -> Iterator[tuple]:
    """``(attempt, provider, text, error, at)`` of each call until one succeeds."""
    n = 0
    for p in chain:
        for turn in range(attempts):
            n += 1
            if turn and wait:
                time.sleep(min(longest, wait * 2 ** (turn - 1)))
            name, at = getattr(p, "__name__", "provider"), datetime.now(timezone.utc).replace(tzinfo=None)
            try:
                yield n, name, p(data), None, at
                return
            except Exception as e:  # noqa: BLE001 - a provider may raise anything
                yield n, name, None, str(e), at


def _of_images(images: DataFrame, rows_of: Callable[[bytes], Iterable[tuple]], schema: str) -> DataFrame:
    ship_package(images.sparkSession)
    names = ["doc_id", "page_no", *[x.strip().split(" ")[0] for x in schema.split(",")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([(d, p, *r) for d, p, data in zip(batch["doc_id"], batch["page_no"], batch["content"]) for r in rows_of(bytes(data))], columns=names)

    return images.select("doc_id", "page_no", "content").mapInPandas(run, f"doc_id string, page_no int, {schema}")


def ocr_attempts(images: DataFrame, provider, fallbacks=(), attempts: int = 3, wait: float = 0.0, longest: float = 30.0) -> DataFrame:
    """``(doc_id, page_no, attempt, provider, text, error, at)``: every call of injected functions ``bytes -> text`` on page images, as an audit; each is tried ``attempts`` times, then the next. Before a repeated call the task waits ``wait`` seconds, twice as long each time up to ``longest``."""
    chain = [provider, *fallbacks]
    return _of_images(images, lambda data: _calls(chain, attempts, wait, longest, data), "attempt int, provider string, text string, error string, at timestamp")


def ocr_pages(images: DataFrame, provider, fallbacks=(), attempts: int = 3, wait: float = 0.0, longest: float = 30.0) -> DataFrame:
    """``(doc_id, page_no, text, provider, error)``: the outcome of the calls of ocr_attempts, the provider null where all failed."""
    chain = [provider, *fallbacks]

    def outcome(data: bytes) -> list[tuple]:
        *_, (_, name, text, error, _) = _calls(chain, attempts, wait, longest, data)
        return [(text, None if error is not None else name, error)]

    return _of_images(images, outcome, "text string, provider string, error string")
