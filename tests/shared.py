"""Names that the tests share; a module of its own, because ``tests/llm`` has a conftest too."""

from __future__ import annotations

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


def as_set(rows, ndigits=6):
    """Order-insensitive, float-tolerant comparable form of result rows."""
    out = []
    for r in rows:
        vals = []
        for v in r:
            if isinstance(v, float):
                vals.append(round(v, ndigits))
            elif isinstance(v, list):
                vals.append(tuple(round(x, ndigits) if isinstance(x, float) else x for x in v))
            else:
                vals.append(v)
        out.append(tuple(vals))
    return sorted(out, key=repr)
