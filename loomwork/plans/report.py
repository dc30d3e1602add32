"""Dashboards from rollup rows: the same figures as JSON, Markdown and HTML.  Rows: one for each dataset and the corpus.

A report has warnings first, then the corpus in a few large figures, a grid of datasets by stages, and a card for
each dataset.  What a frame doesn't hold is left out of tiles and cards, so a rollup of few columns is enough.
"""

from __future__ import annotations

import html
import json
from collections.abc import Iterator

from pyspark.sql import DataFrame

#: Signs and colours of the states of a stage.
STATES = {"done": ("✔", "#3a8f5c"), "in_progress": ("◐", "#c58a1b"), "not_started": ("○", "#8a8f98"), "n/a": ("–", "#c9ccd1")}


def human_bytes(n: float | None) -> str:
    if n is None:
        return "n/a"
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if n < 1024 or unit == "TB":
            return f"{n:.0f} {unit}" if unit == "B" else f"{n:.1f} {unit}"
        n /= 1024
    return "n/a"


def number(n: int | None) -> str:
    return "n/a" if n is None else f"{n:,}"


def percent(permille: int | None) -> str:
    return "n/a" if permille is None else f"{permille / 10:.1f}%"


def usd(nano: int | None, places: int = 2) -> str:
    return "n/a" if nano is None else f"${nano / 1e9:,.{places}f}"


def build(rollup: DataFrame, grid: DataFrame, generated_at: str, version: int = 1, coverage: DataFrame | None = None, projected: DataFrame | None = None) -> dict:
    """The report as a dict; all frames hold a row for each dataset (and stage), so they are small.

    rollup: dataset and any of docs, docs_ok, docs_error, pages, chars, bytes, cost_nano, quarantined, last_activity;
    grid: dataset, stage, applicable, done, state, permille; coverage: what summary.vision_coverage gives;
    projected: dataset, projected_nano.
    """
    sets: dict = {}
    for r in rollup.collect():
        sets[r["dataset"]] = r.asDict() | {"stages": {}}
    for r in grid.collect():
        sets.setdefault(r["dataset"], {"dataset": r["dataset"], "stages": {}})["stages"][r["stage"]] = {k: r[k] for k in ("applicable", "done", "state", "permille")}
    for r in coverage.collect() if coverage else ():
        sets.setdefault(r["dataset"], {"dataset": r["dataset"], "stages": {}})["vision"] = {k: r[k] for k in ("has_visual", "embedded", "not_embedded", "embed_errors", "docs_with_gap", "permille")}
    for r in projected.collect() if projected else ():
        sets.setdefault(r["dataset"], {"dataset": r["dataset"], "stages": {}})["projected_nano"] = r["projected_nano"]
    corpus = sets.pop(None, None)
    found = [sets[k] for k in sorted(sets)]
    return {"schema_version": version, "generated_at": generated_at, "corpus": corpus, "datasets": found, "warnings": [w for d in found for w in warnings(d)]}


def warnings(d: dict) -> Iterator[str]:
    """What of a dataset should be read first: vectors that are missing, documents in quarantine."""
    v = d.get("vision")
    if v and v["docs_with_gap"]:
        failed = f", {number(v['embed_errors'])} errors" if v["embed_errors"] else ""
        yield f"{d['dataset']}: vision embeddings are incomplete, {number(v['embedded'])} of {number(v['has_visual'])} assets ({percent(v['permille'])}), {number(v['docs_with_gap'])} documents with gaps{failed}; run stage 4 again"
    if d.get("quarantined"):
        yield f"{d['dataset']}: {number(d['quarantined'])} documents in quarantine"


def tiles(report: dict) -> list[tuple[str, str, str]]:
    """Value, name and remark of the corpus' large figures."""
    c = report["corpus"] or {}
    out = [(number(len(report["datasets"])), "datasets", "")]
    if "docs" in c:
        out.append((number(c["docs"]), "documents", f"{number(c.get('pages'))} pages" + (f", {human_bytes(c['bytes'])}" if "bytes" in c else "")))
    if "cost_nano" in c:
        out.append((usd(c["cost_nano"]), "spent", f"about {usd(c['projected_nano'])} to finish" if "projected_nano" in c else ""))
    if c.get("vision", {}).get("has_visual"):
        v = c["vision"]
        out.append((percent(v["permille"]), "vision embeddings", f"{number(v['embedded'])} of {number(v['has_visual'])} assets" + (f", {number(v['docs_with_gap'])} documents with gaps" if v["docs_with_gap"] else "")))
    if "quarantined" in c:
        out.append((number(c["quarantined"]), "in quarantine", ""))
    return out


def facts(d: dict) -> list[tuple[str, str]]:
    """Name and value of what a dataset's card tells."""
    out = [("documents", f"{number(d.get('docs'))}" + (f", {number(d['docs_error'])} with errors" if d.get("docs_error") else ""))]
    if "pages" in d:
        out.append(("pages", number(d["pages"]) + (f", {number(d['chars'])} characters" if "chars" in d else "")))
    if "cost_nano" in d:
        out.append(("spent", usd(d["cost_nano"]) + (f", about {usd(d['projected_nano'])} to finish" if "projected_nano" in d else "")))
    if "quarantined" in d:
        out.append(("quarantine", number(d["quarantined"])))
    if d.get("vision", {}).get("has_visual"):
        v = d["vision"]
        out.append(("vision embeddings", f"{number(v['embedded'])} of {number(v['has_visual'])} ({percent(v['permille'])})" + (f", {number(v['docs_with_gap'])} documents with gaps" if v["docs_with_gap"] else "")))
    if d.get("last_activity"):
        out.append(("last activity", str(d["last_activity"])))
    return out


def stages_of(report: dict) -> list[str]:
    return sorted({s for d in [*report["datasets"], report["corpus"] or {}] for s in d.get("stages", {})})


def cell(d: dict, stage: str) -> str:
    s = d.get("stages", {}).get(stage)
    if not s or s["state"] == "n/a":
        return STATES["n/a"][0]
    return f"{STATES[s['state']][0]} {number(s['done'])}/{number(s['applicable'])} {percent(s['permille'])}"


def as_json(report: dict) -> str:
    return json.dumps(report, indent=2, ensure_ascii=False, default=str)


def as_markdown(report: dict) -> str:
    stages = stages_of(report)
    lines = [f"# Corpus, {report['generated_at']}", "", f"Schema {report['schema_version']}", ""]
    lines += [f"> {w}" for w in report["warnings"]] + [""] * bool(report["warnings"])
    lines += ["## Corpus", ""] + [f"- **{value}** {name}" + (f" ({remark})" if remark else "") for value, name, remark in tiles(report)] + [""]
    lines += ["## Progress (done of applicable)", "", "| dataset | documents | " + " | ".join([*stages, "spent"]) + " |", "|---" * (3 + len(stages)) + "|"]
    whole = report["corpus"]
    for d in [*report["datasets"], *([whole | {"dataset": "**all**"}] if whole and len(report["datasets"]) > 1 else [])]:
        lines.append(f"| {d['dataset']} | {number(d.get('docs'))} | " + " | ".join([*(cell(d, s) for s in stages), usd(d.get("cost_nano"))]) + " |")
    for d in report["datasets"]:
        lines += ["", f"### {d['dataset']}", ""] + [f"- {name}: {value}" for name, value in facts(d)]
    return "\n".join(lines) + "\n"


STYLE = """
body { font: 15px/1.45 system-ui, sans-serif; margin: 2rem auto; max-width: 70rem; padding: 0 1rem; color: #222; background: #fbfbfa }
header p { color: #666 } .warning { background: #fdf1dc; border-left: 4px solid #c58a1b; padding: .5rem .8rem; margin: .4rem 0 }
.tiles { display: flex; flex-wrap: wrap; gap: 1rem; margin: 1.5rem 0 } .tile { flex: 1 1 9rem; background: #fff; border: 1px solid #ddd; padding: .8rem 1rem }
.tile b { display: block; font-size: 1.6rem } .tile small, td small { color: #666 }
table { border-collapse: collapse; width: 100% } th, td { text-align: left; padding: .35rem .6rem; border-bottom: 1px solid #e3e3e0; vertical-align: top }
.meter { background: #e8e8e4; height: 5px; margin-top: 3px } .meter i { display: block; height: 5px }
.card { background: #fff; border: 1px solid #ddd; padding: .6rem 1rem; margin: .8rem 0 } dl { display: grid; grid-template-columns: 11rem 1fr; gap: .2rem .8rem; margin: 0 } dt { color: #666 } dd { margin: 0 }
"""


def as_html(report: dict) -> str:
    """One page without scripts and without anything from elsewhere."""
    e = html.escape

    def meter(d: dict, stage: str) -> str:
        s = d.get("stages", {}).get(stage)
        if not s or s["state"] == "n/a":
            return "<td>–</td>"
        sign, colour = STATES[s["state"]]
        width = min(100.0, (s["permille"] or 0) / 10)
        return f"<td title='{e(s['state'])}'>{sign} {number(s['done'])}/{number(s['applicable'])} <small>{percent(s['permille'])}</small><div class='meter'><i style='width:{width:.1f}%;background:{colour}'></i></div></td>"

    stages, whole = stages_of(report), report["corpus"]
    rows = [*report["datasets"], *([whole | {"dataset": "all"}] if whole and len(report["datasets"]) > 1 else [])]
    body = [f"<header><h1>Corpus</h1><p>{e(report['generated_at'])}, schema {report['schema_version']}</p></header>"]
    body += [f"<p class='warning'>{e(w)}</p>" for w in report["warnings"]]
    body.append("<section class='tiles'>" + "".join(f"<div class='tile'><b>{e(v)}</b>{e(n)}<br><small>{e(r)}</small></div>" for v, n, r in tiles(report)) + "</section>")
    head = "".join(f"<th>{e(h)}</th>" for h in ("dataset", "documents", *stages, "spent"))
    grid = "".join(f"<tr><th>{e(str(d['dataset']))}</th><td>{number(d.get('docs'))}</td>{''.join(meter(d, s) for s in stages)}<td>{usd(d.get('cost_nano'))}</td></tr>" for d in rows)
    body.append(f"<h2>Progress</h2><table><thead><tr>{head}</tr></thead><tbody>{grid}</tbody></table><h2>Datasets</h2>")
    body += [f"<section class='card'><h3>{e(str(d['dataset']))}</h3><dl>{''.join(f'<dt>{e(n)}</dt><dd>{e(v)}</dd>' for n, v in facts(d))}</dl></section>" for d in report["datasets"]]
    return f"<!DOCTYPE html><html lang='en'><head><meta charset='utf-8'><title>Corpus</title><style>{STYLE}</style></head><body>{''.join(body)}</body></html>"
