"""SQL counterparts of the registered queries, written against the raw tables.

Each ``.sql`` file holds one query. A first line ``-- needs: a b`` names other files it selects
from; they are put in front as common table expressions, in order of need.
"""

from __future__ import annotations

from functools import cache
from pathlib import Path

FOLDER = Path(__file__).parent


@cache
def _files() -> dict[str, str]:
    return {path.stem: path.read_text(encoding="utf-8") for path in sorted(FOLDER.glob("*.sql"))}


def _needs(name: str) -> list[str]:
    first = _files()[name].split("\n", 1)[0]
    return first.removeprefix("-- needs:").split() if first.startswith("-- needs:") else []


def _ordered(name: str, seen: list[str]) -> list[str]:
    for need in _needs(name):
        if need not in seen:
            _ordered(need, seen)
    if name not in seen:
        seen.append(name)
    return seen


def oracle(name: str, instead: dict[str, str] | None = None) -> str:
    """The full query of a file; ``instead`` gives other files in the place of some parts."""
    instead = instead or {}
    parts: list[str] = []
    for other in instead.values():
        _ordered(other, parts)
    own = [part for part in parts if part not in instead.values()]
    _ordered(name, own)
    body = {part: _files()[instead.get(part, part)] for part in own}
    ctes = ",\n".join(f"{part} AS MATERIALIZED (\n{body[part]}\n)" for part in own if part != name)
    result = f"SELECT * FROM (\n{body[name]}\n) AS result"
    return f"WITH {ctes}\n{result}" if ctes else result


# Queries under a given verdict on the logistics data, or over other texts.
VARIANTS = {
    f"{name}_untrusted": (name, {"dq_domain_trust": "r_untrusted"})
    for name in ("rca_verdict", "decision_briefs", "incident_command_center")
} | {"named_report_validation": ("report_validation", {"r_texts": "r_named"})}


def load_oracles() -> dict[str, str]:
    """All full queries by name; the shared parts are among them."""
    variants = {name: oracle(base, instead) for name, (base, instead) in VARIANTS.items()}
    return {name: oracle(name) for name in _files()} | variants
