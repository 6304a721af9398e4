"""Whole text files: model artifacts, phone numbers in files, contact blocks, what a run has written."""

from __future__ import annotations

import re
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from firmlens.functions import fixed
from firmlens.functions.text import report_cell
from firmlens.operators import contacts
from firmlens.shared import find_package, open_store

#: Folders that written texts are dealt to.
FOLDERS = 256


def read_texts(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path and text of each file below a folder, at any depth."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)  # the reader overrides an option
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def write_texts(texts: DataFrame, folder: str) -> None:
    """texts(name, text) as a file each, name below one of FOLDERS folders by the name's checksum: so that many files are
    neither a folder each nor all in one, and are listed by tasks. Tasks write them in place; a file is seen when it is whole, and
    writing it again changes nothing."""
    spark = texts.sparkSession
    find_package(spark)
    spark._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(spark._jvm.org.apache.hadoop.fs.Path(folder))

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_store(folder)
        made: set[int] = set()
        for frame in frames:
            for name, text in zip(*(c.to_pylist() for c in frame.columns), strict=True):
                at = zlib.crc32(name.encode()) % FOLDERS
                if at not in made:
                    fs.create_dir(f"{path}/{at:03d}", recursive=True)
                    made.add(at)
                part = f"{path}/{at:03d}/_{uuid.uuid4().hex}"
                with fs.open_output_stream(part, compression=None) as f:
                    f.write((text or "").encode())
                fs.move(part, f"{path}/{at:03d}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([frame.num_rows], pa.int64())], names=["files"])

    # a fixed number of partitions: rows are small, the work isn't
    dealt = texts.select("name", "text").repartition(max(2, int(spark.conf.get("spark.sql.shuffle.partitions"))), "name")
    dealt.mapInArrow(run, "files long").agg(F.sum("files")).collect()


def phones_of_files(spark: SparkSession, path: str, glob: str = "*.txt", *, region: str = "DE") -> DataFrame:
    """Phone candidates of text files, with the file's name."""
    texts = read_texts(spark, path, glob).withColumn("file", F.regexp_extract("path", r"([^/]+)$", 1))
    return contacts.candidates(texts.select("file", "text"), region=region)


def below(folder: str) -> Column:
    """A file's path below a folder."""
    return F.substring_index("path", re.sub(r"^file:/*|/+$", "", folder) + "/", -1)


def cache_folders(spark: SparkSession, path: str, name: str = "scraped_content", most_depth: int = 4) -> DataFrame:
    """Folders called `name` that hold files, up to `most_depth` levels below path, with their numbers of files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    inner = below(path)
    parts = F.split(inner, "/")
    at = F.array_position(parts, F.lit(name))
    return files.select(F.when((at > 0) & (at <= most_depth) & (at < F.size(parts)), F.array_join(F.slice(parts, F.lit(1), at.cast("int")), "/")).alias("folder")).where("folder IS NOT NULL").groupBy("folder").agg(F.count(F.lit(1)).alias("files"))


def inventory(spark: SparkSession, path: str) -> DataFrame:
    """(relative_path, size_bytes, modified) of every file below a folder: what a run's manifest lists."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(below(path).alias("relative_path"), F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))


def finalize(spark: SparkSession, live: DataFrame, target: str) -> bool:
    """Write a live table without its __meta_ columns as the final CSV; False, and nothing is written, if it is empty."""
    if not live.head(1):
        return False
    live.select(*[F.col(f"`{c}`") for c in live.columns if not c.startswith("__meta_")]).write.mode("overwrite").options(header=True, quote='"', escape='"').csv(target)
    return True


_PHONE, _TEL, _MAIL, _NAME = (re.compile(p, f) for p, f in ((fixed.CONTACT_PHONE, 0), (fixed.CONTACT_TEL, re.IGNORECASE), (fixed.CONTACT_MAIL, re.IGNORECASE), (fixed.CONTACT_NAME, 0)))


def _number(line: str) -> str:
    spelled, labelled = _PHONE.search(line), _TEL.search(line)
    return spelled[0] if spelled else labelled[1] if labelled else ""


def _next_filled(values: list[str]) -> list[int]:
    """For each place, and the end, the first place from it on that holds something; the length where there is none."""
    out = [len(values)]
    for i in range(len(values) - 1, -1, -1):
        out.append(i if values[i] else out[-1])
    return out[::-1]


def contact_entries(text: str | None, reach: int = 8) -> list[str]:
    """`Name | role | phone | email` of a contact page's lines, once each.

    Lines of noise go; if a heading for contacts stands somewhere, only what follows it counts. Each line is first told to be
    a name, to hold a number, an address. An entry is a name, a role in the next line if that holds neither, and the first
    number and address within `reach` lines; the next entry begins where both were found, or else behind these lines.
    """
    lines = [x for x in map(str.strip, (text or "").splitlines()) if x and not x.lower().strip(": ").startswith(fixed.CONTACT_NOISE)]
    headings = [i for i, x in enumerate(lines) if x.lower() in fixed.CONTACT_HEADINGS]
    table = [(x if _NAME.fullmatch(x) and x.lower() not in fixed.NO_NAMES else "", _number(x), m[0] if (m := _MAIL.search(x)) else "") for x in (lines[headings[0] + 1 :] if headings else lines)]
    lines = lines[len(lines) - len(table) :]
    names, numbers, mails = ([row[k] for row in table] for k in range(3))
    next_name, next_number, next_mail = _next_filled(names), _next_filled(numbers), _next_filled(mails)
    numbers, mails = [*numbers, ""], [*mails, ""]  # behind the end
    found: dict[str, None] = {}
    at = next_name[0]
    while at < len(lines):
        below = at + 1
        titled = below < len(lines) and not numbers[below] and not mails[below]
        role = lines[below] if titled and not any(x in lines[below].lower() for x in fixed.NO_ROLE) else ""
        first = below + titled
        end = min(first + reach, len(lines))
        number, mail = (k if k < end else len(lines) for k in (next_number[first], next_mail[first]))
        entry = [x for x in (names[at], role, numbers[number], mails[mail]) if x]
        if numbers[number] or mails[mail]:
            found[" | ".join(entry)] = None
        at = next_name[max(number, mail) if max(number, mail) < end else end]
    return list(found)


def contact_blocks(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, contacts): the contact entries of each text, joined by ` || `; '' if there are none."""
    find_package(rows.sparkSession)
    kind = dict(rows.dtypes)[key]

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            yield pa.RecordBatch.from_arrays([frame.column(0), pa.array([" || ".join(contact_entries(t)) for t in frame.column(1).to_pylist()], pa.string())], names=[key, "contacts"])

    return rows.select(key, text).mapInArrow(run, f"`{key}` {kind}, contacts string")


def document_texts(spark: SparkSession, path: str) -> DataFrame:
    """(path, text) of Word documents (.docx) below a folder: a line for each paragraph that isn't blank; null where a file can't
    be read. Other kinds of documents are not read."""
    find_package(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.docx").load(path).select("path", "content")

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for at in range(frame.num_rows):
                yield pa.RecordBatch.from_arrays([frame.column(0).slice(at, 1), pa.array([_paragraphs(frame.column(1)[at].as_buffer())], pa.string())], names=["path", "text"])

    return files.mapInArrow(run, "path string, text string")


def _paragraphs(body) -> str | None:
    """Text of a document's paragraphs as they end; each is forgotten then."""
    out: list[str] = []
    try:
        with zipfile.ZipFile(pa.BufferReader(body)) as z, z.open("word/document.xml") as f:
            for _, e in ElementTree.iterparse(f):
                if e.tag.endswith("}p"):
                    out.append("".join([t.text or "" for t in e.iter() if t.tag.endswith("}t")]).strip())
                    e.clear()
    except (zipfile.BadZipFile, KeyError, ElementTree.ParseError):
        return None
    return "\n".join([x for x in out if x])


def document_bundles(texts: DataFrame, key: str, most_chars: int) -> DataFrame:
    """(key, bundle): the texts(key, file, text) of each key under their files' names, by name in any case, cut at most_chars with
    a mark. Blank texts are left out; of a key's texts no more are gathered than fit."""
    part = F.concat(F.lit("=== FILE: "), "file", F.lit(" ===\n"), report_cell(F.col("text")))
    rows = texts.where(F.trim(report_cell(F.col("text"))) != "").select(key, F.lower("file").alias("_low"), "file", part.alias("_part"))
    order = Window.partitionBy(key).orderBy("_low", "file", "_part")
    before = F.coalesce(F.sum(F.length("_part").cast("long") + 2).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    kept = rows.withColumn("_before", before).where(F.col("_before") <= most_chars + 2).withColumn("_part", F.left("_part", F.lit(most_chars + 1)))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_before", "_part"))), lambda p: p["_part"]), "\n\n")
    bundle = kept.groupBy(key).agg(joined.alias("bundle"))
    return bundle.withColumn("bundle", F.when(F.length("bundle") > most_chars, F.concat(F.left("bundle", F.lit(most_chars)), F.lit("\n\n[TRUNCATED]"))).otherwise(F.col("bundle")))
