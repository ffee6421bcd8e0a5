"""Site specs from JSON text: the nested procedures of a site as list rules, detail rules and loops."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..model import FieldRule, Loop, SiteSpec, Transform

def _rule(field: str, body: dict) -> FieldRule:
    transforms = tuple(
        Transform(t["how"], t.get("value"), int(t.get("which", 0)), int(t.get("group", 1)))
        for t in body.get("transforms") or []
        if t.get("how")
    )
    return FieldRule(
        field, body.get("element"), body.get("how") or "XPATH", body.get("method"), body.get("value"),
        bool(body.get("isFatal", True)), transforms,
    )


def _rules(node: dict) -> tuple[FieldRule, ...]:
    extracts = node.get("extracts") or {}
    return tuple(_rule(k, v) for k, v in extracts.items() if not k.startswith("comment:"))


def _children(node: dict) -> list[dict]:
    return [node["procedure"]] if "procedure" in node else list(node.get("procedures") or [])


def spec_of(document: dict) -> SiteSpec:
    found: dict = {"items": None, "pages": None, "outer": None, "list": (), "detail": []}

    def visit(node: dict) -> None:
        loop = node.get("loop") or {}
        kind = loop.get("loop_item_type", "job")
        total = loop.get("loop_totalpages")
        parsed = Loop(
            loop.get("xpath_prefix"), kind, int(loop.get("begin_from", 0)), int(loop.get("end_to", 0)),
            _rule("page_count", total) if total else None,
        )
        if loop.get("loop_type") == "begin" and kind in ("job", "job_addon"):
            found["items"], found["list"] = parsed, _rules(node)
        elif loop.get("loop_type"):
            place = "outer" if kind == "other" else "pages"
            found[place] = found[place] or parsed
        elif _rules(node):
            found["detail"].append(_rules(node))
        for child in _children(node):
            visit(child)

    visit(document)
    id_rule = document.get("job_unique_id_calc") or {}
    return SiteSpec(
        document["name"], found["items"], found["list"], tuple(found["detail"]), found["pages"], found["outer"],
        id_rule.get("how"), id_rule.get("value"),
        document.get("fetch.n.pages"), document.get("fetch.n.days"), document.get("fetch.n.jobs"),
        bool(document.get("check_solr") or document.get("check_index")), bool(document.get("verify_single")),
    )


def read_specs(spark: SparkSession, folder: str, files: str = "*.json") -> list[SiteSpec]:
    """Specs are hand-written settings, one file per site."""
    texts = spark.read.text(f"{folder}/{files}", wholetext=True).toLocalIterator()
    return sorted((spec_of(json.loads(t.value)) for t in texts), key=lambda s: s.site)
