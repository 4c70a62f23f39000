"""CSV, JSON lines, SQLite, documents: reading and writing frames at the edge."""

from __future__ import annotations

import os
import re
import zipfile
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "emptyValue": "", "nullValue": "\x00", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
BOM = "﻿"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings, empty cells as "", a byte order mark dropped."""
    return spark.read.options(**CSV).csv(path)


def flat(df: DataFrame) -> DataFrame:
    """Every column a string: nested ones as JSON, booleans as True and False, null as ""."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.MapType):
            c = F.to_json(F.map_from_entries(F.array_sort(F.map_entries(c))))
        elif isinstance(f.dataType, (T.ArrayType, T.StructType)):
            c = F.to_json(c)
        elif isinstance(f.dataType, T.BooleanType):
            c = F.initcap(c.cast("string"))
        else:
            c = c.cast("string")
        out.append(F.coalesce(c, F.lit("")).alias(f.name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV files, all cells quoted."""
    flat(df).write.mode("overwrite").options(header=True, quoteAll=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def export_csv(df: DataFrame, file: str) -> str:
    """One CSV file with a byte order mark, row by row through the driver; another name where the file is locked."""
    import csv
    import time

    try:
        out = open(file, "w", encoding="utf-8", newline="")
    except PermissionError:
        base, ending = os.path.splitext(file)
        file = f"{base}_{time.strftime('%Y%m%d_%H%M%S')}{ending}"
        out = open(file, "w", encoding="utf-8", newline="")
    with out:
        out.write(BOM)
        w = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n")
        w.writerow(df.columns)
        for row in flat(df).toLocalIterator():
            w.writerow(row)
    return file


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def export_sqlite(tables: dict[str, DataFrame], file: str, indexes: dict[str, list[str]] | None = None) -> None:
    """Tables of text columns in one SQLite file; rows stream through the driver, none are gathered."""
    import sqlite3

    if os.path.exists(file):
        os.remove(file)
    with sqlite3.connect(file) as db:
        db.execute("PRAGMA journal_mode=WAL")
        for name, df in tables.items():
            cols = ", ".join(f'"{c}" TEXT' for c in df.columns)
            db.execute(f'CREATE TABLE "{name}" ({cols})')
            marks = ", ".join("?" * len(df.columns))
            db.executemany(f'INSERT INTO "{name}" VALUES ({marks})', (tuple(r) for r in flat(df).toLocalIterator(prefetchPartitions=True)))
            for c in (indexes or {}).get(name, []):
                db.execute(f'CREATE INDEX "idx_{name}_{c}" ON "{name}" ("{c}")')
    db.close()


def _docx(title: str, text: str) -> bytes:
    """A minimal word-processing document: a title, bold headings, bullets, paragraphs."""
    import io

    def p(line: str, style: str = "", bold: bool = False) -> str:
        pr = f'<w:pPr><w:pStyle w:val="{style}"/></w:pPr>' if style else ""
        return f'<w:p>{pr}<w:r>{"<w:rPr><w:b/></w:rPr>" if bold else ""}<w:t xml:space="preserve">{escape(line)}</w:t></w:r></w:p>'

    body = [p(title, "Heading1", True)]
    for line in re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "", text).split("\n"):
        heading = bool(line) and len(line) < 80 and (line.isupper() or line.endswith(":"))
        body.append(p("• " + line[2:] if line.startswith("- ") else line, bold=heading))
    doc = f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:body>{"".join(body)}</w:body></w:document>'
    kinds = '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>'
    rels = '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", kinds)
        z.writestr("_rels/.rels", rels)
        z.writestr("word/document.xml", doc)
    return out.getvalue()


def write_documents(rows: DataFrame, folder: str, kind: str = "docx") -> None:
    """Write each row ``(file, title, text)`` as a document below a folder all executors share."""

    def save(part):
        for r in part:
            path = os.path.join(folder, r["file"])
            os.makedirs(os.path.dirname(path), exist_ok=True)
            data = _docx(r["title"], r["text"] or "") if kind == "docx" else (BOM + (r["text"] or "")).encode()
            with open(path, "wb") as f:
                f.write(data)

    rows.select("file", "title", "text").foreachPartition(save)


def write_attachments(raw: DataFrame, folder: str) -> None:
    """Attachment payloads of raw messages to ``<folder>/<source>/<message>/<number>_<hash>_<name>``."""
    from missiva.functions.text import sanitize_filename

    files = raw.select(F.regexp_replace("source_pst", r"\.pst$", "").alias("s"), F.sha2(F.coalesce("message_id", F.col("raw_id").cast("string")), 256).alias("m"), F.posexplode("attachment_payloads").alias("k", "a"))
    files = files.select("s", F.substring("m", 1, 24).alias("m"), "k", sanitize_filename(F.col("a.filename"), "attachment").alias("name"), F.col("a.payload").alias("payload"))

    def save(part):
        import hashlib

        for r in part:
            data = bytes(r["payload"] or b"")
            path = os.path.join(folder, r["s"] or "unknown", r["m"])
            os.makedirs(path, exist_ok=True)
            with open(os.path.join(path, f"{r['k'] + 1:03d}_{hashlib.sha256(data).hexdigest()[:12]}_{r['name']}"), "wb") as f:
                f.write(data)

    files.foreachPartition(save)
