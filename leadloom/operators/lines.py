"""Records in lines of text: fixed-width registers with wrapped rows, and entries under section headings.

Lines are rows (file, number, text), so order is a column. A file of any length is scanned in parts that carry the header, the
section and the number of records on (``segments.scanned``), so one long register is read by many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadloom.operators.segments import scanned


def text_lines(df: DataFrame, row_id: str, text_col: str) -> DataFrame:
    """(id, line_no, line) of every text."""
    return df.select(row_id, F.posexplode(F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), r"\r?\n")).alias("line_no", "line"))


def fixed_width_records(lines: DataFrame, file: str, columns: list[str], starts: Column, *, line_no: str = "line_no", line: str = "line") -> DataFrame:
    """(file, record, fields: map from column to its parts in order) of a fixed-width register.

    A line that holds all column names is a header: it sets the positions of the lines after it. ``starts`` is evaluated
    on the lines' struct ``cells`` and says where a record begins; lines until the next one belong to it, so wrapped cells
    are further parts. Blank lines end a record. Lines before the first header are left out.
    """
    is_header = F.lit(True)
    for c in columns:
        is_header = is_header & F.col(line).contains(c)
    at = F.when(is_header, F.array(*[F.instr(F.col(line), c) for c in columns]))
    placed = scanned(lines.select(file, line_no, line).withColumn("head", is_header), [file], [line_no], last={"places": at}).where("places is not null and not head")
    width = lambda k: (F.get("places", k + 1) - F.get("places", k)) if k + 1 < len(columns) else F.length(line) + 1
    cells = F.struct(*[F.trim(F.col(line).substr(F.get("places", k), F.greatest(width(k), F.lit(0)))).alias(c) for k, c in enumerate(columns)])
    rows = placed.withColumn("cells", cells).withColumn("blank", F.trim(F.col(line)) == "")
    rows = rows.withColumn("opens", F.coalesce(starts, F.lit(False)) & ~F.col("blank"))
    rows = scanned(rows.select(file, line_no, "cells", "blank", "opens"), [file], [line_no], sums={"record": F.col("opens").cast("long"), "stops": F.col("blank").cast("long")})
    first = Window.partitionBy(file, "record")
    rows = rows.withColumn("since", F.min(F.when(F.col("opens"), F.col("stops"))).over(first)).where("record > 0 and not blank and stops = since")
    part = lambda c: F.transform(F.array_sort(F.collect_list(F.when(F.col("cells")[c] != "", F.struct(F.col(line_no).alias("o"), F.col("cells")[c].alias("v"))))), lambda s: s["v"])
    return rows.groupBy(file, "record").agg(F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[part(c) for c in columns])).alias("fields"))


def under_headings(lines: DataFrame, row_id: str, heading: str, entry: str, *, line_no: str = "line_no", line: str = "line") -> DataFrame:
    """(id, line_no, section, parts) of the lines that match ``entry`` below a line that matches ``heading``.

    ``section`` is the heading's first group in lower case, ``parts`` the entry's groups. Another markdown heading ends a
    section. Entries of the same parts count once, the first of them, in each text.
    """
    text = F.trim(F.col(line))
    head = F.lower(F.regexp_extract(text, heading, 1))
    mark = F.when(head != "", head).when(text.rlike(r"^#+\s"), "")
    rows = scanned(lines, [row_id], [line_no], last={"section": mark}).where((F.col("section") != "") & text.rlike(entry))
    groups = entry.count("(") - entry.count("(?") - entry.count(r"\(")
    parts = F.array(*[F.trim(F.regexp_extract(text, entry, k + 1)) for k in range(groups)])
    same = Window.partitionBy(row_id, "__same").orderBy(line_no)
    rows = rows.select(row_id, line_no, "section", parts.alias("parts")).withColumn("__same", F.lower(F.array_join("parts", "|")))
    return rows.withColumn("__rn", F.row_number().over(same)).where("__rn = 1").drop("__rn", "__same")
