"""Delimited files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from clonespark.sources.lines import numbered_lines

NULLS = ["", "-", "None", "N/A"]


def header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """The first line's cells, without quotes."""
    line = spark.read.text(path).limit(1).collect()
    return [c.strip("\"' ") for c in line[0][0].rstrip("\n").split(sep)] if line else []


def _cells(spark: SparkSession, path: str, sep: str, names: list[str] | None) -> tuple[DataFrame, list[str]]:
    """Lines as arrays of cells (split without quoting), with their order; the header line of each file is left out."""
    given = names or header(spark, path, sep)
    lines = numbered_lines(spark, path).filter(F.trim("value") != "").filter(F.col("line") >= (0 if names else 1))
    pattern = "".join(f"\\{c}" if not c.isalnum() and c != "\t" else c for c in sep)
    return lines.select(F.col("line").alias("_row_id"), F.split(F.regexp_replace("value", r"[\r\n ]+$", ""), pattern, -1).alias("c")), given


def read_padded(spark: SparkSession, path: str, sep: str = ",", names: list[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """All rows: short ones are filled with empty cells, long ones cut. NULL is the string None, quotes are removed. Adds _row_id."""
    cells, given = _cells(spark, path, sep, names)
    value = lambda i: F.regexp_replace(F.coalesce(F.get("c", F.lit(i)), F.lit("")), "[\"']", "")
    return _cast(cells.select("_row_id", *(F.when(value(i) == "NULL", "None").otherwise(value(i)).alias(n) for i, n in enumerate(given))), schema)


def read_exact(spark: SparkSession, path: str, sep: str = ",", names: list[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """Rows as wide as the header; others are dropped. Cells with - or _ are strings, unless the schema says otherwise. Adds _row_id."""
    cells, given = _cells(spark, path, sep, names)
    return _cast(cells.filter(F.size("c") == len(given)).select("_row_id", *(F.regexp_replace(F.get("c", F.lit(i)), "[\"']", "").alias(n) for i, n in enumerate(given))), schema)


def _cast(df: DataFrame, schema: StructType | None) -> DataFrame:
    if schema is None:
        return df
    return df.withColumns({f.name: F.when(F.col(f.name).isin(NULLS), None).otherwise(F.col(f.name)).try_cast(f.dataType) if not isinstance(f.dataType, StringType) else F.col(f.name) for f in schema if f.name in df.columns})


def read_table(spark: SparkSession, path: str, schema: StructType | str, sep: str = ",", na: str = "N/A") -> DataFrame:
    """The plain case: quoted CSV of a declared schema, na as null."""
    return spark.read.csv(path, schema=schema, sep=sep, header=True, nullValue=na, mode="PERMISSIVE")


def read_reads(spark: SparkSession, path: str) -> DataFrame:
    """sequence and readcount from a file of two columns with any header; other widths are an error."""
    if len(header(spark, path)) != 2:
        raise ValueError("a file of reads has two columns")
    return spark.read.csv(path, schema="sequence string, readcount bigint", header=True)


def read_edges(spark: SparkSession, path: str, sep: str = ",", positive: bool = False) -> DataFrame:
    """from, to, dist; with positive only edges of a distance over 0."""
    edges = spark.read.csv(path, schema="`from` string, `to` string, dist int", sep=sep, header=True)
    return edges.filter("dist > 0") if positive else edges


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """A reference of genes: name, full_NT and index, its place in the file from 0."""
    genes, _ = _cells(spark, path, ",", ["name", "full_NT"])
    rows = genes.filter(F.get("c", F.lit(0)) != "name").sort("_row_id").collect()  # a reference of some hundred genes
    return spark.createDataFrame([(r["c"][0], r["c"][1], i) for i, r in enumerate(rows)], "name string, full_NT string, index int")


def read_union(spark: SparkSession, paths: list[str], sep: str = ",") -> DataFrame:
    """Files of one header as one table."""
    return spark.read.csv(paths, header=True, sep=sep)


def write_table(df: DataFrame, path: str, columns: list[str] | None = None, sep: str = ",", na: str | None = None, mode: str = "overwrite", rows_per_file: int = 0) -> None:
    """The columns in that order, with a header, quoted where need be. mode ignore leaves what is there; na stands for null."""
    chosen = df.select(*(columns or df.columns))
    if na is not None:
        chosen = chosen.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(na)).alias(c) for c in chosen.columns))
    chosen.write.option("maxRecordsPerFile", rows_per_file).csv(path, header=True, sep=sep, mode=mode)


def write_workbook(tables: dict[str, DataFrame], path, highlight: Column | None = None, most_rows: int = 1_000_000, widths: dict[str, list[tuple[int, int, float]]] | None = None) -> None:
    """A sheet for each table, as an Office Open XML workbook. Small results only: more rows than most_rows are an error.

    path: a path or an open binary file. {bg_color:name} fragments of a cell and rows for which highlight holds get a fill. widths: of a sheet's columns, as
    (first, last, width), columns counted from 0.
    """
    import re
    import zipfile
    from xml.sax.saxutils import escape, quoteattr

    fills, sheets = ["FFFFFFFF"], {}
    colours = {"gray": "FF808080", "red": "FFFF0000", "green": "FF92D050", "yellow": "FFFFFF00"}
    for name, df in tables.items():
        rows = (df.withColumn("_high", highlight) if highlight is not None else df).limit(most_rows + 1).collect()
        if len(rows) > most_rows:
            raise ValueError(f"{name} has over {most_rows} rows")
        lines = [df.columns, *([r[c] for c in df.columns] for r in rows)]
        marks = [False, *(bool(r["_high"]) if highlight is not None else False for r in rows)]
        xml = []
        for line, mark in zip(lines, marks):
            cells = []
            for value in line:
                text = "" if value is None else str(value)
                found = re.findall(r"\{bg_color:([^{}]*)\}", text)
                text = re.sub(r"\{[^{}]*\}", "", text)
                colour = "FF92D050" if mark else colours.get(found[-1], "FFC0C0C0") if found else None
                style = 0 if colour is None else (fills.index(colour) if colour in fills else fills.append(colour) or len(fills) - 1)
                number = isinstance(value, (int, float)) and not isinstance(value, bool)
                cells.append(f'<c s="{style}"><v>{value}</v></c>' if number else f'<c s="{style}" t="inlineStr"><is><t>{escape(text)}</t></is></c>')
            xml.append(f"<row>{''.join(cells)}</row>")
        cols = "".join(f'<col min="{a + 1}" max="{b + 1}" width="{w}" customWidth="1"/>' for a, b, w in (widths or {}).get(name, ()))
        sheets[name] = f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">{f"<cols>{cols}</cols>" if cols else ""}<sheetData>{"".join(xml)}</sheetData></worksheet>'
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml."
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i + 1}.xml" ContentType="{kinds}worksheet+xml"/>' for i in range(len(sheets)))
        z.writestr("[Content_Types].xml", f'<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="{kinds}sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{kinds}styles+xml"/>{parts}</Types>')
        z.writestr("_rels/.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>{"".join(f"<sheet name={quoteattr(n)} sheetId=\"{i + 1}\" r:id=\"r{i + 1}\"/>" for i, n in enumerate(sheets))}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{"".join(f"<Relationship Id=\"r{i + 1}\" Type=\"{rel}/worksheet\" Target=\"worksheets/sheet{i + 1}.xml\"/>" for i in range(len(sheets)))}<Relationship Id="s" Type="{rel}/styles" Target="styles.xml"/></Relationships>')
        fill = "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="{c}"/></patternFill></fill>' if i else '<fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill>' for i, c in enumerate(fills))
        z.writestr("xl/styles.xml", f'<styleSheet xmlns="{main}"><fonts count="1"><font/></fonts><fills count="{len(fills) + 1}">{fill}</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="{len(fills)}">{"".join(f"<xf fillId=\"{i + 1 if i else 0}\" applyFill=\"1\"/>" for i in range(len(fills)))}</cellXfs></styleSheet>')
        for i, xml in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", xml)


def union_folders(spark: SparkSession, folders: list[str], out: str, names: list[str], sep: str = ",") -> None:
    """For each name, the files of that name in all folders as one table in a folder of that name; one header."""
    for name in names:
        read_union(spark, [f"{f}/{name}" for f in folders], sep).write.csv(f"{out}/{name}", header=True, sep=sep, mode="overwrite")


def read_config(path: str, section: str, spark: SparkSession | None = None, **values: str) -> dict[str, str]:
    """A section of an INI file, with $name in it replaced by values; the file stays as it is. With a session, from any store that Spark reads."""
    import configparser
    from string import Template

    if spark is not None:
        text = spark.read.text(path, wholetext=True).first()[0]
    else:
        with open(path, encoding="utf-8") as f:
            text = f.read()
    parser = configparser.ConfigParser(interpolation=None)
    parser.optionxform = str
    parser.read_string(Template(text).safe_substitute(values))
    return dict(parser[section])
