"""HMAC-SHA256 from the built-in ``sha2``, and the canonical record text it covers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable

_BLOCK = 64


def _pads(key: bytes) -> tuple[str, str]:
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key).hex(), bytes(b ^ 0x5C for b in key).hex()


def hmac_sha256(x: str, key: bytes) -> str:
    """Hex HMAC of a string expression under ``key``."""
    inner, outer = _pads(key)
    digest = f"sha2(concat(X'{inner}', encode({x}, 'UTF-8')), 256)"
    return f"sha2(concat(X'{outer}', unhex({digest})), 256)"


def canonical_json(columns: Iterable[str]) -> str:
    """JSON of the given columns with keys in order; a null column is an absent key."""
    fields = ", ".join(f"'{c}', `{c}`" for c in sorted(columns))
    return f"to_json(named_struct({fields}))"


def canonical_line(raw: str) -> str:
    """Canonical text of a stored JSON line without its own ``mac`` and ``hash`` keys.

    The variant type keeps object keys sorted, number spelling of integers, explicit nulls and
    array positions, so unknown fields of a record are covered by its MAC too, and so are keys of these
    names inside of them.
    """
    line = f"try_parse_json({raw})"
    entries = f"try_variant_get({line}, '$', 'map<string, variant>')"
    return f"coalesce(to_json(map_filter({entries}, (k, v) -> k NOT IN ('hash', 'mac'))), to_json({line}))"
