"""Folders of CSV and Parquet files as payload rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from pitchflow.session import scratch_path

CSV, PARQUET = "*.[cC][sS][vV]", "*.[pP][aA][rR][qQ][uU][eE][tT]"
PAYLOAD = "source_file string, payload variant"


def _as_payload(df: DataFrame) -> DataFrame:
    # an object keeps a key whose cell is empty; to_json would leave it out
    data = [c for c in df.columns if c != "_source_file"]
    return df.select(
        F.col("_source_file").alias("source_file"),
        F.to_variant_object(F.struct(*[F.col(f"`{c}`") for c in data])).alias("payload"),
    )


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the scratch folder and read it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _files(spark: SparkSession, pattern: str):
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)


def _paths(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Files below `path`; their contents are not read."""
    found = _files(spark, pattern).format("binaryFile").load(path).select("path")
    return sorted(r["path"] for r in found.collect())


# A cell of a record, as far as it goes on this side of a comma: in quotes, where two quotes stand for one, or plain. A quote within a plain
# cell is an ordinary character, and so is what follows a closing quote. Possessive, so that long cells take linear time.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+'
_CELL = rf'(?:{_QUOTED}"[^,]*+|[^,"][^,]*+)?+'
_OPENS = rf"(?:{_CELL},)*+{_QUOTED}"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all CSV files, read once and kept: file, source_file, block, line, value, and whether the line ends within quotes
    if it begins outside (`e0`) or within (`e1`). `line` grows with the place in a block, and is a line's own in the whole folder.
    """
    found = _files(spark, CSV).option("lineSep", "\n").text(path)
    meta = [F.col(f"_metadata.{a}").alias(b) for a, b in (("file_path", "file"), ("file_name", "source_file"), ("file_block_start", "block"))]
    quoted = F.col("value").contains('"')
    return staged(
        found.select(
            *meta,
            F.monotonically_increasing_id().alias("line"),
            "value",
            (quoted & F.col("value").rlike(rf"^{_OPENS}\z")).alias("e0"),
            (~quoted | F.col("value").rlike(rf'^[^"]*+(?:""[^"]*+)*+(?:"[^,]*+,{_OPENS})?\z')).alias("e1"),
        ),
        "csv_lines",
    )


def _after(open_: Column, known: str, flips: str) -> Column:
    """Whether quotes are open behind some steps: the last one that settles it, if any, and how often it turned since."""
    base = F.coalesce(F.col(f"{known}.open"), open_)
    turned = (F.col(flips) - F.coalesce(F.col(f"{known}.flips"), F.lit(0))) % 2 == 1
    return base != turned


def _scanned(steps: DataFrame, over: WindowSpec) -> DataFrame:
    """Steps with the number of turns so far and the last step that settles whether quotes are open."""
    rows = steps.withColumn("flips", F.sum((F.col("e0") & ~F.col("e1")).cast("long")).over(over))
    settles = F.when(F.col("e0") == F.col("e1"), F.struct(F.col("e0").alias("open"), "flips"))
    return rows.withColumn("known", F.last(settles, ignorenulls=True).over(over))


def _starts(lines: DataFrame) -> DataFrame:
    """(file, block, line, blank, begins0, begins1, ends0, ends1): whether quotes are open before and behind each line, if they are not,
    or are, before its block."""
    over = Window.partitionBy("file", "block").orderBy("line")
    blank = F.col("value").rlike(r"^\r?\z").alias("blank")
    rows = _scanned(lines.select("file", "block", "line", "e0", "e1", blank), over)
    for k, start in enumerate((False, True)):
        rows = rows.withColumn(f"ends{k}", _after(F.lit(start), "known", "flips"))
        rows = rows.withColumn(f"begins{k}", F.lag(f"ends{k}", 1, start).over(over))
    return rows.drop("flips", "known", "e0", "e1")


def _blocks(rows: DataFrame) -> DataFrame:
    """(file, block, open, before, first, until): whether a block begins within quotes, the last record that began before it, and, of a
    file's first block, the lines between which its first record lies that is no blank line."""
    ends = F.max_by(F.struct("ends0", "ends1"), "line").alias("ends")
    last = [F.max(F.when(~F.col(f"begins{k}"), F.col("line"))).alias(f"last{k}") for k in (0, 1)]
    starts = F.when(~F.col("begins0") & ~F.col("blank"), F.col("line"))
    first = F.min(starts).over(Window.partitionBy("file", "block"))
    beyond = F.when(~F.col("begins0") & (F.col("line") > F.col("first")), F.col("line"))
    rows = rows.withColumn("first", first)
    each = rows.groupBy("file", "block").agg(ends, *last, F.min("first").alias("first"), F.min(beyond).alias("until"))
    over = Window.partitionBy("file").orderBy("block")
    each = _scanned(each.select("*", F.col("ends.ends0").alias("e0"), F.col("ends.ends1").alias("e1")), over)
    each = each.withColumn("open", F.lag(_after(F.lit(False), "known", "flips"), 1, False).over(over))
    own = F.when(F.col("open"), F.col("last1")).otherwise(F.col("last0"))
    earlier = over.rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("before", F.last(own, ignorenulls=True).over(earlier)).select("file", "block", "open", "before", "first", "until")


def _records(lines: DataFrame, multi_line: bool) -> tuple[DataFrame, DataFrame]:
    """Records (file, source_file, line, text) by the line they begin with, and (file, line, text) of the headers."""
    if not multi_line:
        records = lines.select("file", "source_file", "line", F.col("value").alias("text"))
        written = lines.filter((F.col("block") == 0) & ~F.col("value").rlike(r"^\r?\z"))
        first = written.groupBy("file").agg(F.min(F.struct("line", "value")).alias("h"))
        return records, first.select("file", "h.line", F.col("h.value").alias("text"))
    rows = _starts(lines)
    blocks = staged(_blocks(rows), "csv_blocks")
    placed = rows.join(blocks.select("file", "block", "open", "before"), ["file", "block"])
    begins, ends = (F.when(F.col("open"), F.col(f"{x}1")).otherwise(F.col(f"{x}0")) for x in ("begins", "ends"))
    over = Window.partitionBy("file", "block").orderBy("line")
    record = F.coalesce(F.last(F.when(~begins, F.col("line")), ignorenulls=True).over(over), F.col("before")).alias("record")
    placed = placed.select("line", begins.alias("begins"), ends.alias("ends"), record)
    several = staged(placed.filter("begins or ends").select("line", "record"), "csv_parts")
    alone = lines.join(several, "line", "left_anti").select("file", "source_file", "line", F.col("value").alias("text"))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "line", "value"))), lambda x: x["value"]), "\n")
    joined = lines.join(several, "line").groupBy("file", "source_file", F.col("record").alias("line")).agg(text.alias("text"))
    heads = blocks.filter("block = 0 and first is not null").select("file", "first", "until")
    within = (F.col("line") >= F.col("first")) & (F.col("until").isNull() | (F.col("line") < F.col("until")))
    text = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n")
    header = lines.filter("block = 0").select("file", "line", "value").join(heads, "file").filter(within)
    return alone.unionByName(joined), header.groupBy("file").agg(F.min("first").alias("line"), text.alias("text"))


def _cells(text: Column) -> Column:
    """The cells of a record; one without any character is NULL."""
    record = F.concat(F.lit(","), F.regexp_replace(text, r"\r\z", ""))

    def cell(c: Column) -> Column:
        inner = F.replace(F.regexp_extract(c, rf"^({_QUOTED})", 1).substr(F.lit(2), F.length(c)), F.lit('""'), F.lit('"'))
        rest = F.regexp_extract(c, rf'^{_QUOTED}"([^,]*+)\z', 1)
        return F.when(c.startswith('"'), F.concat(inner, rest)).when(c != "", c)

    return F.transform(F.regexp_extract_all(record, F.lit(rf",({_QUOTED}\z|{_CELL})"), F.lit(1)), cell)


def read_csv_payload(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Every record of every `*.csv` below `path`: source_file, payload. Cells stay text, no inference; an empty one is NULL.

    Each file has its own header, its first record that is no blank line: columns may differ between files, in order and in number. Of
    columns of one name the last counts, a name may be empty, cells that a record lacks are NULL, and those beyond the
    header are a list under the name `null`. Blank lines are left out; files without a line give no row.

    A quoted cell may hold line breaks. Where records begin is found for all blocks of a file at once: each line turns,
    settles or keeps whether quotes are open, so a block does, and the blocks of a file are then gone through in order. Only records of
    several lines are shuffled by text; a quote that never closes makes the rest of its file, up to
    its last line break, one record. With
    `multi_line=False` every line is a record. The lines are kept below the session's scratch folder while the result is in use.
    """
    lines = _lines(spark, path)
    records, headers = _records(lines, multi_line)
    cells = F.posexplode_outer(_cells(F.regexp_replace("text", "^\ufeff", ""))).alias("at", "name")
    names = headers.select("file", F.col("line").alias("header"), cells)
    names = names.groupBy("file", "header", F.coalesce("name", F.lit("")).alias("name")).agg(F.max("at").alias("at"))
    names = names.groupBy("file", "header").agg(F.sort_array(F.collect_list(F.struct("at", "name"))).alias("names"), (F.max("at") + 1).alias("width"))
    # the table of headers is written, so that its size is known when the join is chosen
    rows = records.join(staged(names, "csv_headers"), "file").filter("line <> header and not text rlike '^\\r?\\\\z'")
    rows = rows.select("source_file", "names", "width", _cells(F.col("text")).alias("cells"))
    more = F.size("cells") > F.col("width")

    def entry(name: Column, value: Column) -> Column:
        return F.struct(name.alias("name"), value.cast("variant").alias("value"))

    named = F.transform("names", lambda n: entry(n["name"], F.get("cells", n["at"])))
    beyond = F.array(entry(F.lit("null"), F.slice("cells", F.col("width") + 1, F.greatest(F.size("cells") - F.col("width"), F.lit(0)))))
    entries = F.when(more, F.concat(F.filter(named, lambda e: e["name"] != "null"), beyond)).otherwise(named)
    return rows.select("source_file", F.to_variant_object(F.map_from_entries(entries)).alias("payload"))


def read_tabular_payload(
    spark: SparkSession, path: str, has_csv: bool = True, has_parquet: bool = True, multi_line: bool = True
) -> DataFrame:
    """Rows of the CSV and Parquet files below `path`, of either or both kinds; every other file is skipped.

    Columns of all Parquet files are kept; a column that a file lacks is NULL in its payloads. Either kind can be
    left out by its flag.
    """
    rows = read_csv_payload(spark, path, multi_line) if has_csv else spark.createDataFrame([], PAYLOAD)
    files = _paths(spark, path, PARQUET) if has_parquet else []
    if files:
        df = spark.read.option("mergeSchema", "true").parquet(*files)
        rows = rows.unionByName(_as_payload(df.select("*", F.col("_metadata.file_name").alias("_source_file"))))
    return rows
