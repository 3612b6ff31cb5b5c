"""Manifests of a stage's tables and a self-contained HTML report."""

from __future__ import annotations

import html
import io
import json
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def describe(df: DataFrame) -> dict:
    """Rows, columns and an order-free digest of a table."""
    got = df.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("x"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("s")).first()
    return {"rows": got["n"], "columns": dict(df.dtypes), "digest": f"{(got['x'] or 0) & (2**64 - 1):016x}-{got['s'] or 0}"}


def manifest(stage: str, run_id: str, outputs: dict[str, DataFrame], params: dict, seconds: float, warnings: int = 0, inputs: dict[str, DataFrame] | None = None) -> dict:
    """What a stage read and wrote: rows, columns and digests of both."""
    tables = {"inputs": {k: describe(v) for k, v in (inputs or {}).items()}, "outputs": {k: describe(v) for k, v in outputs.items()}}
    return {"stage": stage, "run_id": run_id, "params": params, "duration_seconds": round(seconds, 3), "warnings": warnings} | tables


def html_report(title: str, sections: dict[str, DataFrame], most: int = 10_000) -> str:
    """One page with every section as a table and its rows as JSON.  For small results: more than ``most`` rows raise ValueError."""
    body, data = [], {}
    for name, df in sections.items():
        rows = df.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{name} has more than {most} rows")
        data[name] = [r.asDict(recursive=True) for r in rows]
        cells = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in rows)
        body.append(f"<h2>{html.escape(name)}</h2><table><tr>{''.join(f'<th>{html.escape(c)}</th>' for c in df.columns)}</tr>{cells}</table>")
    payload = json.dumps(data, default=str).replace("</", "<\\/")
    return f'<!doctype html><meta charset="utf-8"><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>{"".join(body)}<script type="application/json" id="data">{payload}</script>'


_WORD = "http://schemas.openxmlformats.org/wordprocessingml/2006/main"
_PARTS = {
    "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/word/document.xml" ContentType="application/vnd.openxmlformats-officedocument.wordprocessingml.document.main+xml"/></Types>',
    "_rels/.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="word/document.xml"/></Relationships>',
}


def _paragraph(text: str, size: int = 22, bold: bool = False, italic: bool = False) -> str:
    look = f'<w:sz w:val="{size}"/>' + ("<w:b/>" if bold else "") + ("<w:i/>" if italic else "")
    return f'<w:p><w:r><w:rPr>{look}</w:rPr><w:t xml:space="preserve">{html.escape(text, quote=False)}</w:t></w:r></w:p>'


def docx_report(title: str, report: DataFrame, headings: dict[str, str], most: int = 10_000) -> bytes:
    """A Word document of a report's insights: a heading for each section, and below each insight its support and texts.

    report: what ``topline`` gives, with title, finding and, if there, evidence_basis, scope_or_caveat, why_it_matters.  headings:
    section to heading, in order; other sections are left out by the caller's choice.  More than ``most`` rows raise ValueError."""
    rows = report.orderBy("report_order", "category_bucket", "title").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the report has more than {most} rows")
    body = [_paragraph(title, 36, True), _paragraph(f"{len(rows)} insights", italic=True)]
    for section, heading in headings.items():
        own = [r.asDict() for r in rows if r["report_section"] == section]
        if own:
            body.append(_paragraph(heading, 30, True))
        for r in own:
            body.append(_paragraph(r["title"] or "", 26, True))
            body.append(_paragraph(" | ".join(str(x) for x in (r.get("category_bucket"), f"{r['supporting_projects']} projects", f"{r['n_topics']} topics") if x is not None), italic=True))
            body += [_paragraph(r[c]) for c in ("finding", "evidence_basis", "scope_or_caveat", "why_it_matters") if r.get(c)]
    document = f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?><w:document xmlns:w="{_WORD}"><w:body>{"".join(body)}</w:body></w:document>'
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in {**_PARTS, "word/document.xml": document}.items():
            z.writestr(zipfile.ZipInfo(name), text)
    return out.getvalue()
