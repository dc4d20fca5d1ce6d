"""Manifests: read strictly, and judged by a declaration of their fields."""

from __future__ import annotations

import json
import re

from rillstone.sources.arrow_ipc import _filesystem
from rillstone.sources.schemas import MANIFEST

_TYPES = {"string": str, "boolean": bool, "bigint": int}


def read_manifest(path: str) -> tuple[dict | None, list[tuple]]:
    """The manifest with the contract's fields (unknown ones are dropped), or a finding: it can't be read, is no JSON,
    or a field has another type. Counts and levels must be whole numbers from 0 up."""
    bad = lambda step, e: (None, [(f"manifest.{step}", "ERROR", "Manifest", "manifest", str(e))])
    try:
        fs, p = _filesystem(path)
        with fs.open_input_file(p) as f:
            raw = f.read()
    except OSError as e:
        return bad("read", e)
    try:
        doc = json.loads(raw)
    except ValueError as e:
        return bad("json_parse", e)
    if not isinstance(doc, dict):
        return bad("deserialize", "the manifest is no object")
    out: dict = {}
    for f_ in MANIFEST.fields:
        v = doc.get(f_.name)
        kind = f_.dataType.simpleString()
        if v is None:
            ok = True
        elif kind == "array<double>":
            ok = isinstance(v, list) and all(isinstance(x, (int, float)) and not isinstance(x, bool) for x in v)
            v = [float(x) for x in v] if ok else None
        else:
            ok = isinstance(v, _TYPES[kind]) and (kind == "boolean" or not isinstance(v, bool))
            ok = ok and not (f_.name in ("atom_count", "fabric_level") and v < 0)
        if not ok:
            return bad("deserialize", f"field {f_.name} has a wrong type or value")
        out[f_.name] = v
    return out, []


#: What each field of a manifest must be, as a declaration.
DECLARED = {
    "format_version": {"type": "string", "required": True, "const": "0.1"},
    "fabric_name": {"type": "string", "required": True, "pattern": r"[a-z][a-z0-9_-]*"},
    "fabric_version": {"type": "string"},
    "fabric_level": {"type": "integer", "minimum": 0},
    "crs": {"type": "string", "required": True, "const": "EPSG:4326"},
    "has_up_area": {"type": "boolean", "required": True},
    "has_rasters": {"type": "boolean", "required": True},
    "has_snap": {"type": "boolean", "required": True},
    "flow_dir_encoding": {"type": "string", "enum": ["esri", "taudem"], "required_if": ("has_rasters", True)},
    "terminal_sink_id": {"type": "integer", "required": True, "const": 0},
    "topology": {"type": "string", "required": True, "enum": ["tree", "dag"]},
    "region": {"type": "string"},
    "bbox": {"type": "array", "items": "number", "required": True, "size": 4},
    "atom_count": {"type": "integer", "required": True, "minimum": 1},
    "created_at": {"type": "string", "required": True},
    "adapter_version": {"type": "string", "required": True, "pattern": r".+"},
}
_KINDS = {"string": str, "boolean": bool, "integer": int, "number": (int, float), "array": list}


def _is(v, kind: str) -> bool:
    return isinstance(v, _KINDS[kind]) and (kind == "boolean" or not isinstance(v, bool))


def declared_problems(doc, fields: dict = DECLARED) -> list[tuple[str, str]]:
    """(field, problem) of a JSON document by the declaration; empty if it meets it. Fields not declared are allowed."""
    if not isinstance(doc, dict):
        return [("", "is no object")]
    out = []
    for name, rule in fields.items():
        v = doc.get(name)
        if v is None:
            on, value = rule.get("required_if", (None, None))
            if rule.get("required") or on and doc.get(on) == value:
                out.append((name, "is missing"))
            continue
        if not _is(v, rule["type"]) or rule["type"] == "array" and not all(_is(x, rule["items"]) for x in v):
            out.append((name, f"is no {rule['type']}"))
            continue
        tests = [
            ("const" in rule and v != rule.get("const"), f"is not {rule.get('const')}"),
            ("enum" in rule and v not in rule.get("enum", ()), f"is none of {', '.join(rule.get('enum', ()))}"),
            ("pattern" in rule and not re.fullmatch(rule.get("pattern", ""), str(v), re.S), "has a wrong form"),
            ("minimum" in rule and not isinstance(v, str) and v < rule.get("minimum", 0), f"is below {rule.get('minimum')}"),
            ("size" in rule and isinstance(v, list) and len(v) != rule.get("size"), f"has not {rule.get('size')} items"),
        ]
        out += [(name, text) for bad, text in tests if bad]
    return out
