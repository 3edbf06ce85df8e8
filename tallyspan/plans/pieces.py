"""Queries of folders, listings, links, pages, rows and pairs over the driver's tables, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspan.functions import periods
from tallyspan.operators import grids, merge, reshape
from tallyspan.sources import filings as sources
from tallyspan.sources.tables import table


def period_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The folders of every quarter with figures."""
    there = merge.known_periods(table(spark, sf_dir, "value_pdf").where("year is not null and quarter is not null"), "year", "quarter")
    return there.select("year", "quarter", reshape.period_paths("data", F.col("year"), F.col("quarter")).alias("p")).select("year", "quarter", "p.*")


def file_availability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which sheets each segment has a file of, by name patterns in order of preference."""
    listing = table(spark, sf_dir, "sheet_file").select("segment_id", F.col("file_name").alias("file"))
    patterns = {s: (f"{s}%2020%.json", f"{s}%.json") for s in ("sheet1", "sheet2", "sheet3")}
    return reshape.availability(listing.select("segment_id").distinct(), listing, patterns, ["segment_id"])


def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per segment and year the first of the name forms of its fourth quarter that exists."""
    files = table(spark, sf_dir, "sheet_file").where("sheet = 'sheet1'").select(F.concat_ws(" ", "segment_id", F.regexp_extract("file_name", "[0-9]{4}", 0)).alias("key"), F.col("file_name").alias("file"))
    years = files.select("key").distinct().select("key", F.substring("key", -4, 4).alias("y"))
    forms = [F.concat(F.lit("sheet1_"), F.col("y"), F.lit("_QIV.json")), F.concat(F.lit("sheet1_IVQ"), F.col("y"), F.lit(".json")), F.concat(F.lit("sheet1_"), F.col("y"), F.lit("_Q4.json"))]
    return sources.first_existing(files, years.select("key", F.posexplode(F.array(*forms)).alias("rank", "file")))


def link_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters that links name by date; dates outside a quarter's last month name none."""
    day = F.date_format("o_orderdate", "dd-MM-yyyy")
    html = F.concat(F.lit("<a class=x href='f"), F.col("o_orderkey").cast("string"), F.lit(".pdf'>al "), day, F.lit("</a><a href='none'>otro</a>"))
    return sources.page_periods(table(spark, sf_dir, "orders").select("o_orderkey", html.alias("html")), ["o_orderkey"], "html")


def xml_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that a path selects in a column of XML."""
    xml = F.concat(F.lit("<r><n>"), F.col("n_name"), F.lit("</n><m><n>"), F.col("n_nationkey").cast("string"), F.lit("</n></m></r>"))
    return table(spark, sf_dir, "nation").select("n_nationkey", F.array_join(sources.xpath_texts(xml, "//n/text()"), "/").alias("texts"))


def data_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as data addresses, hashed."""
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(F.replace(reshape.data_url(F.encode("text", "UTF-8"), "text/plain"), F.lit("\r\n"), F.lit(""))).alias("address_md5"))


def piped_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of pipe tables within texts made of line items."""
    text = F.concat(F.lit("antes\n| concepto | actual |\n|---|---|\n| "), F.regexp_replace("concepto", r"[|\n\r]", " "), F.lit(" | "), F.coalesce(F.col("ytd_actual").cast("string"), F.lit("n/d")), F.lit(" |\ndespués | sola\n\nfin"))
    found = grids.markdown_tables(table(spark, sf_dir, "line_item").where("concepto is not null").select("item_id", text.alias("text")), ["item_id"], "text")
    return found.select("item_id", "table_idx", "row_idx", F.size("cells").alias("n_cells"), F.md5(F.get("cells", F.lit(1))).alias("second_md5"))


def row_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The value of the label line that names costs, aligned with it or else the row's first."""
    cells = F.array("concepto", F.col("ytd_actual").cast("string"), F.col("ytd_anterior").cast("string"))
    labels = F.split("concepto", "\n")
    at = grids.label_index(labels, ["costo"])
    return table(spark, sf_dir, "line_item").where("concepto is not null").select("item_id", at.alias("at"), grids.value_offset(labels, at).alias("ahead"), grids.value_from_row(cells, ["costo"]).alias("value"))


def kept_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of brand and type without those that a rule table excludes."""
    pairs = table(spark, sf_dir, "part").select("p_brand", "p_type").distinct()
    return reshape.exclude_pairs(pairs, "p_brand", "p_type", spark.createDataFrame([("1", "COPPER"), ("BRASS", "2")], "first string, second string"))


def roman_quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters to Roman numerals and back."""
    roman = periods.quarter_to_roman(F.col("quarter"))
    return table(spark, sf_dir, "kpi_value").select("value_id", roman.alias("roman"), periods.roman_to_quarter(F.lower(roman)).alias("back"))


QUERIES = {f.__name__: f for f in (period_folders, file_availability, listed_files, link_quarters, xml_texts, data_addresses, piped_tables, row_values, kept_pairs, roman_quarters)}

_LIKE = "coalesce(min(file_name) filter (file_name like '{0}%2020%.json'), min(file_name) filter (file_name like '{0}%.json')) as {0}"
_LABELS = "string_split(concepto, chr(10))"

SQL = {
    "period_folders": """
      select year, quarter, 'data/raw/' || year || '/Q' || quarter as raw, 'data/processed/' || year || '_Q' || r as processed, 'data/output/' || year as output, 'data/audit/' || year || '_Q' || r as audit
      from (select distinct year, quarter, ['I', 'II', 'III', 'IV'][quarter] as r from value_pdf where year is not null and quarter is not null)""",
    "file_availability": f"select segment_id, {', '.join(_LIKE.format(s) for s in ('sheet1', 'sheet2', 'sheet3'))} from sheet_file group by 1",
    "listed_files": """
      with f as (select segment_id || ' ' || regexp_extract(file_name, '[0-9]{4}') as key, file_name as file, regexp_extract(file_name, '[0-9]{4}') as y from sheet_file where sheet = 'sheet1'),
      r as (select key, file, case file when 'sheet1_' || y || '_QIV.json' then 0 when 'sheet1_IVQ' || y || '.json' then 1 when 'sheet1_' || y || '_Q4.json' then 2 end as rank from f)
      select distinct key, file, rank::int as rank from r where rank is not null qualify min(rank) over (partition by key) = rank""",
    "link_quarters": "select o_orderkey, 'f' || o_orderkey || '.pdf' as href, year(o_orderdate)::int as year, (month(o_orderdate) / 3)::int as quarter from orders where month(o_orderdate) % 3 = 0",
    "xml_texts": "select n_nationkey, n_name || '/' || n_nationkey as texts from nation",
    "data_addresses": "select doc_id, md5('data:text/plain;base64,' || base64(encode(text))) as address_md5 from documents",
    "piped_tables": """
      select item_id, 0 as table_idx, 0 as row_idx, 2 as n_cells, md5('actual') as second_md5 from line_item where concepto is not null
      union all select item_id, 0, 1, 2, md5(coalesce(ytd_actual::varchar, 'n/d')) from line_item where concepto is not null
      union all select item_id, 0, 2, 2, md5('sola') from line_item where concepto is not null""",
    "row_values": f"""
      with l as (select item_id, {_LABELS} as ls, list_filter([ytd_actual, ytd_anterior], lambda v: v is not null) as vs from line_item where concepto is not null),
      a as (select *, list_position(list_transform(ls, lambda x: contains(lower(x), 'costo')), true) - 1 as pos from l),
      b as (select *, len(list_filter(list_slice(ls, 1, coalesce(greatest(pos, 0), 0)::bigint), lambda x: regexp_matches(list_last(regexp_split_to_array(trim(x), '\\s+')), '[0-9]'))) as ahead from (select item_id, ls, vs, case when pos >= 0 then pos end as pos from a))
      select item_id, pos::int as "at", ahead::int as ahead, case when pos is not null then coalesce(case when vs[ahead + 1] > 0 then vs[ahead + 1] end, list_filter(vs, lambda v: v > 0)[1]) end as value from b""",
    "kept_pairs": "select distinct p_brand, p_type from part where not ((contains(p_brand, '1') and contains(p_type, 'COPPER')) or (contains(p_brand, 'COPPER') and contains(p_type, '1')) or (contains(p_brand, 'BRASS') and contains(p_type, '2')) or (contains(p_brand, '2') and contains(p_type, 'BRASS')))",
    "roman_quarters": "select value_id, ['I', 'II', 'III', 'IV'][quarter] as roman, case when quarter between 1 and 4 then quarter end as back from kpi_value",
}
