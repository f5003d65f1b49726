"""Chemistries: read structures declared in YAML, checked and turned into layouts for extract_parts.

A chemistry names, for each library, a pattern with a letter for each base, and what the letters stand for. It runs on the driver: definitions are small files.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame

#: Kinds of parts, the columns that their reference tables need, and the largest reference that may be text.
NEEDED = {"barcode": {"symbol", "sequence", "well_coordinate"}, "handle": {"symbol", "sequence"}, "linker": {"symbol", "sequence"}, "UMI": set(), "sample_index": {"symbol", "sequence"}}
MOST_TEXT = 100 * 1024


def load(text: str) -> dict:
    """Definitions from YAML text."""
    import yaml

    found = yaml.safe_load(text)
    if not found:
        raise ValueError("the chemistry definition is empty")
    problems = []
    for chemistry, own in found.items():
        if not isinstance(own, dict) or not isinstance(own.get("structure"), dict) or not own["structure"]:
            problems.append(f"{chemistry}: structure is missing")
            continue
        for library, s in own["structure"].items():
            problems += [f"{chemistry}.structure.{library}: {k} is missing" for k, kind in (("pattern", str), ("mappings", dict)) if not isinstance((s or {}).get(k), kind)]
    if problems:
        raise ValueError("; ".join(problems))
    return found


def parts_of(pattern: str, mappings: dict[str, dict[str, str]], offset: int = 0) -> list[dict]:
    """The parts of a pattern in their order: name, letter, type, start from 0, length."""
    parts = [{"name": name, "letter": letter, "type": kind} for kind, own in mappings.items() for letter, name in own.items()]
    letters = {p["letter"] for p in parts}
    if lost := set(pattern) - letters:
        raise ValueError(f"letters of the pattern that nothing is mapped to: {','.join(sorted(lost))}")
    if more := letters - set(pattern):
        raise ValueError(f"mapped letters that the pattern lacks: {','.join(sorted(more))}")
    for letter in letters:
        if letter * pattern.count(letter) not in pattern:
            raise ValueError(f"letter {letter} is in several stretches of {pattern}")
    if kinds := {p["type"] for p in parts} - set(NEEDED):
        raise ValueError(f"unknown types of parts: {','.join(sorted(kinds))}")
    return sorted([p | {"start": pattern.index(p["letter"]) + offset, "length": pattern.count(p["letter"])} for p in parts], key=lambda p: p["start"])


def demultiplexing(libraries: dict[str, list[dict]], letters: list[str]) -> dict | None:
    """full, if each library has one of the letters; partial, if only some have; nothing if parts with them outnumber the libraries."""
    if letters and not any(p["letter"] in letters for own in libraries.values() for p in own):
        raise ValueError(f"demultiplexing symbols {letters} aren't mapped")
    n = sum(p["letter"] in letters for own in libraries.values() for p in own)
    if len(libraries) < n:
        return None
    return {"type": "full" if len(libraries) == n else "partial", "symbols": letters}


def check_reference(kind: str, path: str, size: int, table: DataFrame, letters: set[str]) -> None:
    """A reference's size, columns and symbols."""
    if size > MOST_TEXT and not path.endswith(".parquet"):
        raise ValueError(f"{path} has {size} bytes: text of over {MOST_TEXT} should be Parquet")
    if lost := NEEDED.get(kind, set()) - set(table.columns):
        raise ValueError(f"{path} lacks columns: {sorted(lost)}")
    if "symbol" in table.columns:
        known = {r["symbol"] for r in table.select("symbol").where("symbol IS NOT NULL").distinct().collect()}  # a symbol is one letter
        if known and letters - known:
            raise ValueError(f"{path} lacks symbols: {sorted(letters - known)}")


def compiled(definitions: dict, reference: Callable[[str], tuple[int, DataFrame]] | None = None) -> dict:
    """Checked definitions, ready for JSON. reference: size and table of a path; without it references aren't looked into."""
    out = {}
    for chemistry, own in definitions.items():
        libraries = {k: parts_of(s["pattern"], s["mappings"], s.get("offset", 0)) for k, s in own["structure"].items()}
        kinds = {p["type"] for parts in libraries.values() for p in parts}
        references = {k: r.get("path") for k, r in (own.get("references") or {}).items() if k in kinds}
        for kind, path in references.items():
            if path and reference:
                check_reference(kind, path, *reference(path), {p["letter"] for parts in libraries.values() for p in parts if p["type"].lower() == kind.lower()})
        letters = (own.get("demultiplexing") or {}).get("parts") or []
        out[chemistry] = {"id": chemistry, "description": own.get("description", "No description provided."), "libraries": libraries, "references": references, "demultiplexing_strategy": demultiplexing(libraries, list(letters))}
    return out


def to_json(found: dict) -> str:
    return json.dumps(found, indent=4) + "\n"


def layout(found: dict, library: str, *kinds: str) -> dict[str, tuple[int, int]]:
    """A library's parts (of some types) as a layout for extract_parts: first base, from 1, and bases, by letter."""
    return {p["letter"]: (p["start"] + 1, p["length"]) for p in found["libraries"][library] if not kinds or p["type"] in kinds}


def least_length(found: dict, library: str) -> int:
    """Bases that a read needs."""
    return max(p["start"] + p["length"] for p in found["libraries"][library])
