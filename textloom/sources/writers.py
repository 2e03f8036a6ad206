"""Writers. An existing output is refused unless asked otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_line(*columns: str, rest: str | None = None) -> Column:
    """A document as one JSON object, non-ASCII characters as they are; null fields are left out."""
    return F.to_json(F.col(rest)) if rest else F.to_json(F.struct(*columns))


def write_jsonl(docs: DataFrame, path: str, *columns: str, order: str | None = None, mode: str = "errorifexists") -> None:
    """JSON lines; with ``order`` the files follow one another in it."""
    rows = docs.sort(order) if order else docs
    rows.select(json_line(*(columns or docs.columns))).write.mode(mode).text(path)


def newline_document(text: Column, output_lf: int = 2) -> Column:
    """A document and the line feeds that end it; the writer itself adds the last one."""
    return F.concat(text, F.repeat(F.lit("\n"), F.lit(output_lf)))


def write_newline_documents(docs: DataFrame, path: str, text: str = "text", output_lf: int = 2, order: str | None = None, mode: str = "errorifexists") -> None:
    rows = docs.sort(order) if order else docs
    rows.select(newline_document(F.col(text), output_lf)).write.mode(mode).text(path)


def write_split(docs: DataFrame, path: str, status: str = "status", order: str | None = None, mode: str = "errorifexists") -> None:
    """One pass, one folder per status: kept and removed documents, or matched and mismatched pairs."""
    rows = docs.sortWithinPartitions(order) if order else docs
    rows.write.mode(mode).partitionBy(status).json(path)


def output_name(path: str, tag: str, folder: str | None = None) -> str:
    """Where the result of a file goes: its name with ``tag`` before the ending, beside it or in ``folder``."""
    head, _, name = path.rpartition("/")
    stem, dot, ending = name.rpartition(".")
    name = f"{stem}{tag}.{ending}" if dot and stem else name + tag
    at = head if folder is None else folder.rstrip("/")
    return f"{at}/{name}" if at else name


def write_report(reports: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The near-duplicate report as text, groups by their best document."""
    reports.sort("best_document_id").select("report").write.mode(mode).text(path)


def write_parts(docs: DataFrame, path: str, file: str = "source_file", mode: str = "errorifexists") -> None:
    """One folder per source file."""
    docs.write.mode(mode).partitionBy(file).json(path)


def write_pairs(pairs: DataFrame, path: str, tag: str = "_lang", mode: str = "errorifexists") -> None:
    """Four outputs of tagged pairs: source and target, matched and mismatched, lines in order."""
    for side in ("src", "tgt"):
        for status in ("matched", "mismatched"):
            pairs.filter(F.col("status") == status).sort("pos").select(F.coalesce(side, F.lit(""))).write.mode(mode).text(f"{path}/{side}{tag}_{status}")
