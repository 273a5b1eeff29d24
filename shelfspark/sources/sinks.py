"""Sinks: Parquet is the native one; CSV, JSON and Markdown are for people and carry formatted text."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

AUDIT_HEADER = ("item_id_A", "item_id_B", "score", "retrieval_score", "top1_top2_margin", "source", "decision", "reason", "llm_confidence")


def write_csv(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """A folder of CSV parts with a header; null as an empty cell. With ``order`` the parts follow each other in that order."""
    text = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns))
    (text.orderBy(*order) if order else text).write.mode("overwrite").option("header", True).option("escape", '"').option("emptyValue", "").csv(path)


def write_one_csv(df: DataFrame, path: str, header: tuple[str, ...], order: list[str]) -> int:
    """One file with CRLF line ends, streamed in order partition by partition; returns its rows."""
    import csv

    Path(path).parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(header)
        for row in df.orderBy(*order).toLocalIterator():
            writer.writerow(["" if v is None else v for v in row])
            n += 1
    return n


def write_matches(pairs: DataFrame, path: str) -> int:
    return write_one_csv(pairs.select("item_id_a", "item_id_b"), path, ("item_id_A", "item_id_B"), ["item_id_a"])


def write_audit(audit: DataFrame, path: str) -> int:
    return write_one_csv(audit.select(*(c.lower() for c in AUDIT_HEADER)), path, AUDIT_HEADER, ["item_id_a"])


def write_stats(stats: dict, path: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text(json.dumps(stats, indent=2, sort_keys=True, ensure_ascii=False, default=str) + "\n", encoding="utf-8")


def markdown_table(df: DataFrame, most_rows: int = 1000) -> str:
    """A small DataFrame as a Markdown table; larger ones are cut with a note."""
    rows = df.limit(most_rows + 1).collect()
    cell = lambda v: "" if v is None else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    lines += ["| " + " | ".join(cell(v) for v in r) + " |" for r in rows[:most_rows]]
    return "\n".join(lines + (["", f"(first {most_rows} rows)"] if len(rows) > most_rows else []))


def markdown_report(title: str, sections: dict[str, DataFrame | str]) -> str:
    parts = [f"# {title}"]
    for name, body in sections.items():
        parts += [f"## {name}", body if isinstance(body, str) else markdown_table(body)]
    return "\n\n".join(parts) + "\n"
