"""Raw CSV files: explicit schema, captured rejects, landing copy and proof."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from risklake.config import RAW_SCHEMA
from risklake.session import written

BAD_LINE = "_linha_ruim"
#: Folder name of a landed file's parts.
ORIGIN = "arquivo"
#: Bytes of a file under one leaf of its digest tree, and leaves under one node.
DIGEST_BYTES, DIGEST_FAN = 1 << 20, 1024


def write_raw_csv(df: DataFrame, path: str) -> None:
    """CSV with header; values keep their surrounding blanks."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def header_line(schema: T.StructType = RAW_SCHEMA) -> str:
    return ",".join(schema.names)


# A cell in quotes up to its closing quote; doubled and escaped quotes are content.
_QUOTED = r'(?:[^"\\]++|\\.|"")*+'
#: A line that starts outside quotes and ends inside: whole cells, then one that stays open.
_OPENS = rf'^(?:(?:"{_QUOTED}"[^,]*+|[^",][^,]*+|),)*+"{_QUOTED}\\?$'
_CLOSES = rf'^{_QUOTED}"[^,]*+(?:,|$)'
#: Longest record in lines; what opens a quote and runs longer is malformed, line by line.
MOST_LINES = 1000


def _quote_states(line: Column) -> tuple[Column, Column]:
    """Whether the line ends inside quotes if it starts outside, and if it starts inside.

    A line without a quote keeps the state it starts in; it is not searched further.
    """
    quoted, closes = line.contains('"'), line.rlike(_CLOSES)
    rest = F.regexp_replace(line, _CLOSES, "")
    return quoted & line.rlike(_OPENS), ~quoted | ~closes | rest.rlike(_OPENS)


def _ordered_lines(spark: SparkSession, path: str, line_end: str | None = None) -> DataFrame:
    """Lines with their file, the byte range they were read from, and their order within it.

    The parts that a landing copy makes of a file are ranges of that file, in the
    order of their part numbers.
    """
    reader = spark.read.option("lineSep", line_end) if line_end else spark.read
    lines, meta = reader.text(path), F.col("_metadata")
    landed = ORIGIN in lines.columns
    number = F.regexp_extract(meta["file_name"], r"^part-(\d+)", 1).try_cast("bigint") if landed else F.lit(0)
    return lines.select(
        "value",
        (F.col(ORIGIN).cast("string") if landed else _origin(meta)).alias("_file"),
        F.struct(number.alias("n"), meta["file_path"].alias("p"), meta["file_block_start"].alias("b")).alias("_range"),
        F.monotonically_increasing_id().alias("_at"),
    )


def _origin(meta: Column) -> Column:
    """Name of a source file, unique among files of one name in several folders."""
    return F.concat(meta["file_name"], F.lit("-"), F.lower(F.hex(F.xxhash64(meta["file_path"]))))


def _numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Ordered lines with what each makes of the quote state."""
    outside, inside = _quote_states(F.col("value"))
    return _ordered_lines(spark, path).select("*", outside.alias("_opens"), inside.alias("_stays"))


def _records(lines: DataFrame) -> DataFrame:
    """Records of files in which cells run over line ends; each file may be split into many ranges.

    A line turns the quote state it starts in into the one it ends in: it keeps it,
    flips it, or sets it. Only lines that do not keep it are put in order, by number and
    without their text. Every range composes them under either starting state; a pass over
    the ranges of a file, one row each, then tells the state each starts in. Lines of a
    range are numbered one after the other, so a record is an interval of numbers.
    """
    whole = ["_file", "_range"]
    opens, stays = F.col("_opens"), F.col("_stays")
    earlier = Window.partitionBy("_file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = lines.groupBy(*whole).agg(F.min("_at").alias("_from"), F.count("*").alias("_size"))
    # A range is named by its first line's number; its base counts the file's lines before it.
    ranges = written(ranges.select("*", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_base")), "faixas")
    turning = lines.where(opens | ~stays).select(*whole, "_at", "_opens", "_stays")
    turning = turning.join(ranges, whole).select("_from", "_at", "_opens", "_stays")
    order = Window.partitionBy("_from").orderBy("_at")
    inside = order.rowsBetween(Window.unboundedPreceding, 0)
    turned = turning.withColumn("_flips", F.sum((opens & ~stays).cast("int")).over(inside))
    # What the last line that sets the state set it to, and the flips up to there.
    sets = F.when(opens == stays, F.struct(opens.cast("int").alias("v"), F.col("_flips").alias("f")))
    turned = turned.withColumn("_set", F.last(sets, ignorenulls=True).over(inside))

    def ends(start: Column) -> Column:
        since = F.col("_flips") - F.coalesce(F.col("_set.f"), F.lit(0))
        return (F.coalesce(F.col("_set.v"), start) + since) % 2

    turned = written(turned.select("_from", "_at", ends(F.lit(0)).alias("_end0"), ends(F.lit(1)).alias("_end1")), "viradas")
    of_range = turned.groupBy("_from").agg(*[F.max_by(c, "_at").alias(c) for c in ("_end0", "_end1")])
    ordered = F.array_sort(F.collect_list(F.struct("_base", "_from", "_end0", "_end1")))
    # One row per range, so the list of a file is as short as it has ranges.
    step = F.aggregate(
        "_ranges",
        F.array(F.lit(0)),
        lambda acc, r: F.concat(
            acc, F.array(F.when(F.element_at(acc, -1) == 0, r["_end0"]).otherwise(r["_end1"]).cast("int"))
        ),
    )
    starts = (
        of_range.join(ranges, "_from").groupBy("_file").agg(ordered.alias("_ranges"))
        .select(F.inline(F.arrays_zip(F.col("_ranges._from").alias("_from"), step.alias("_start"))))
        .where("_from IS NOT NULL")
    )
    known = turned.join(starts, "_from").withColumn("_ends", F.when(F.col("_start") == 0, F.col("_end0")).otherwise(F.col("_end1")))
    known = known.withColumn("_begins", F.coalesce(F.lag("_ends").over(order), F.col("_start")))
    # What is left opens and closes by turns.
    known = known.where("_begins <> _ends").withColumn("_close", F.lead("_at").over(order))
    turns = written(known.select("_from", "_at", "_ends", "_close"), "aspas")
    opened = turns.where("_ends = 1")
    near = opened.where(F.col("_close") - F.col("_at") < MOST_LINES).select(
        F.col("_at").alias("_record"), F.posexplode(F.sequence("_at", "_close")).alias("_place", "_at")
    )
    # What a range leaves open, once at most, closes with the first turn of a later range.
    first = turns.groupBy("_from").agg(F.min("_at").alias("_first")).join(ranges, "_from")
    later = Window.partitionBy("_file").orderBy("_base")
    closing = F.lead(F.col("_first") - F.col("_from") + F.col("_base")).over(later)
    left_open = opened.where("_close IS NULL").join(first.select("_file", "_from", "_base", closing.alias("_q")), "_from")
    left_open = left_open.select(
        "_file", F.col("_at").alias("_record"), (F.col("_at") - F.col("_from") + F.col("_base")).alias("_p"), "_q"
    ).where(F.col("_q") - F.col("_p") < MOST_LINES)
    pieces = left_open.join(ranges, "_file").where("_base <= _q AND _base + _size > _p")
    a = F.col("_from") + F.greatest(F.col("_p") - F.col("_base"), F.lit(0))
    z = F.col("_from") + F.least(F.col("_q") - F.col("_base"), F.col("_size") - 1)
    skipped = F.greatest(F.col("_base") - F.col("_p"), F.lit(0))
    far = pieces.select("_record", skipped.alias("_skipped"), F.posexplode(F.sequence(a, z)).alias("_place", "_at"))
    far = far.select("_record", (F.col("_skipped") + F.col("_place")).cast("int").alias("_place"), "_at")
    members = written(near.unionByName(far), "registros-citados")
    texts = lines.select("value", "_at")
    joined = texts.join(members, "_at").groupBy("_record").agg(
        F.array_sort(F.collect_list(F.struct("_place", "value"))).alias("_l")
    )
    alone = texts.join(members.select("_at"), "_at", "left_anti").select("value")
    return alone.unionByName(joined.select(F.array_join(F.col("_l.value"), "\n").alias("value")))


def record_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per CSV record: its line, or its lines where a quoted cell holds line breaks.

    One pass looks for files with a line that ends inside quotes. All other files are
    taken line by line, without a shuffle. A quote that is never closed, or not within
    MOST_LINES lines, leaves its lines as they are.
    """
    lines = _numbered_lines(spark, path)
    quoted = written(lines.where("_opens").select("_file").distinct(), "arquivos-citados")
    plain = lines.join(quoted, "_file", "left_anti").select("value")
    return plain.unionByName(_records(written(lines.join(quoted, "_file"), "linhas-abertas")))


def read_as_text(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Every declared column as text, plus the whole line when its shape is wrong.

    Records are read as text and parsed one by one; line breaks within quoted cells
    become a line feed. Header lines are recognised by content, quoted or not,
    wherever they stand: a landing copy splits large files, so most of
    its parts carry no header and "skip the first line" would lose data. Nor can
    column pruning hide a malformed line from a query that skips its columns.
    """
    text = T.StructType(
        [T.StructField(n, T.StringType()) for n in schema.names]
        + [T.StructField(BAD_LINE, T.StringType())]
    )
    parsed = F.from_csv(
        "value",
        ", ".join(f"`{f.name}` string" for f in text.fields),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE, "multiLine": "true"},
    )
    lines = record_lines(spark, path).where(F.col("value") != "")
    # Inlined, so that each record is parsed once and not again for each cell that a filter names.
    cells = lines.select(F.inline(F.array(parsed)))
    is_header = F.col(schema.names[0]).eqNullSafe(F.lit(schema.names[0])) & F.array(
        *[F.col(n) for n in schema.names]
    ).eqNullSafe(F.array(*[F.lit(n) for n in schema.names]))
    return cells.where(~is_header)


def _failed(field: T.StructField):
    raw = F.col(field.name)
    return raw.isNotNull() & raw.try_cast(field.dataType).isNull()


def reject_cells(text: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """One record per cell that does not parse, and one per malformed line."""
    key = schema.fields[0].name
    bad_shape = F.col(BAD_LINE).isNotNull() if BAD_LINE in text.columns else F.lit(False)
    cells = [
        F.when(
            ~bad_shape & _failed(f),
            F.struct(F.lit(f.name).alias("coluna"), F.col(f.name).alias("valor")),
        )
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    if BAD_LINE in text.columns:
        cells.append(
            F.when(
                bad_shape, F.struct(F.lit("*").alias("coluna"), F.col(BAD_LINE).alias("valor"))
            )
        )
    found = F.filter(F.array(*cells), lambda c: c.isNotNull())
    return text.select(F.col(key), F.explode(found).alias("erro")).select(key, "erro.*")


def typed_rows(text: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Rows whose every cell parses, in the declared types; other columns pass through."""
    bad = F.lit(False)
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            bad = bad | _failed(f)
    if BAD_LINE in text.columns:
        bad = bad | F.col(BAD_LINE).isNotNull()
    others = [c for c in text.columns if c not in schema.names and c != BAD_LINE]
    return text.where(~bad).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], *others
    )


def read_raw(
    spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA
) -> tuple[DataFrame, DataFrame]:
    """(rows that obey the schema, one reject record per offending cell)."""
    text = read_as_text(spark, path, schema)
    return typed_rows(text, schema), reject_cells(text, schema)


def land_copy(spark: SparkSession, src: str, dst: str) -> None:
    """Copy files to the landing folder byte by byte, a folder per file, a part per byte range.

    Only line feeds end a line here, so carriage returns stay content. Every task
    copies its ranges in order, without a shuffle; a last line without its end gets one.
    """
    lines = _ordered_lines(spark, src, "\n").withColumn(ORIGIN, F.col("_file"))
    ordered = lines.sortWithinPartitions(ORIGIN, "_at").select("value", ORIGIN)
    ordered.write.mode("overwrite").partitionBy(ORIGIN).option("lineSep", "\n").text(dst)


def file_digests(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Data lines, bytes and content digest of every file, wherever a copy was cut into parts.

    A digest tree: lines hash with their byte offset, lines of a fixed range of the
    file add up, ranges hash in order to nodes and nodes to the file. Any changed,
    moved, lost or repeated byte changes it. Only hashes and lengths are shuffled.
    """
    lines = _ordered_lines(spark, path, "\n").select(
        "_file", "_range", F.xxhash64("_file", "_range").alias("_key"), "_at",
        (F.octet_length("value").cast("bigint") + 1).alias("_n"),
        F.xxhash64(F.col("value").cast("binary")).alias("_h"),
        (F.rtrim("value", F.lit("\r")) != header_line(schema)).alias("_data"),
    )
    # Lines are shuffled by a number for their range: its names are longer than all the rest.
    ranges = lines.groupBy("_file", "_range", "_key").agg(F.sum("_n").alias("_size"))
    before = Window.partitionBy("_file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("_file", "_key", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("_key").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    placed = lines.drop("_file", "_range").withColumn("_offset", F.coalesce(F.sum("_n").over(inside), F.lit(0))).join(ranges, "_key")
    placed = placed.withColumn("_offset", F.col("_offset") + F.col("_base"))
    leaves = placed.groupBy("_file", F.floor(F.col("_offset") / DIGEST_BYTES).alias("_leaf")).agg(
        F.sum(F.xxhash64("_h", "_offset").cast("decimal(38,0)")).cast("string").alias("_d"),
        F.sum("_n").alias("bytes"), F.count_if("_data").alias("linhas"),
    )

    def merged(rows: DataFrame, child: str, *keys: Column | str) -> DataFrame:
        digests = F.array_sort(F.collect_list(F.struct(child, "_d")))["_d"]
        return rows.groupBy(*keys).agg(
            F.sha2(F.concat_ws(",", digests), 256).alias("_d"), F.sum("bytes").alias("bytes"), F.sum("linhas").alias("linhas")
        )

    nodes = merged(leaves, "_leaf", "_file", F.floor(F.col("_leaf") / DIGEST_FAN).alias("_node"))
    return merged(nodes, "_node", "_file").select(
        F.col("_file").alias(ORIGIN), "linhas", "bytes", F.col("_d").alias("resumo")
    )


def reconcile_bytes(
    spark: SparkSession, src: str, dst: str, schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    """One row: data lines on both sides, and whether every file's bytes are the same on both."""
    a = file_digests(spark, src, schema).select(ORIGIN, F.struct("linhas", "bytes", "resumo").alias("origem"))
    b = file_digests(spark, dst, schema).select(ORIGIN, F.struct("linhas", "bytes", "resumo").alias("destino"))
    both = a.join(b, ORIGIN, "full_outer")
    return both.agg(
        F.coalesce(F.sum("origem.linhas"), F.lit(0)).alias("linhas_origem"),
        F.coalesce(F.sum("destino.linhas"), F.lit(0)).alias("linhas_destino"),
        F.coalesce(F.bool_and(F.col("origem").eqNullSafe(F.col("destino"))), F.lit(True)).alias("integro"),
    )


def _fingerprint(lines: DataFrame, header: str) -> DataFrame:
    """Order-insensitive content proof that also notices repeated lines."""
    h = F.xxhash64("value")
    return lines.agg(
        F.count_if(F.col("value") != header).alias("linhas"),
        F.expr("bit_xor(xxhash64(value))").alias("xor"),
        F.sum(h.cast("decimal(38,0)")).alias("soma"),
    )


def reconcile(
    spark: SparkSession, src: str, dst: str, schema: T.StructType = RAW_SCHEMA
) -> DataFrame:
    """One row: data lines on both sides and whether they are the same lines, in any order and files."""
    header = header_line(schema)
    a = _fingerprint(spark.read.text(src), header).select(
        F.lit(1).alias("k"), F.struct("*").alias("origem")
    )
    b = _fingerprint(spark.read.text(dst), header).select(
        F.lit(1).alias("k"), F.struct("*").alias("destino")
    )
    return a.join(b, "k").select(
        F.col("origem.linhas").alias("linhas_origem"),
        F.col("destino.linhas").alias("linhas_destino"),
        (F.col("origem") == F.col("destino")).alias("integro"),
    )


def file_signatures(spark: SparkSession, path: str) -> DataFrame:
    """MD5 per file, for landing folders of modest files."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", F.md5("content").alias("md5"))
    )
