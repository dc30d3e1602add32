"""Settings from KEY=VALUE lines, as a shell would read them: what stands in quotes is kept, comments after other values go."""

from __future__ import annotations

import re

#: A key, then a quoted value, or one that ends before a comment.
SETTING = re.compile(r"""﻿?\s*(?P<key>[^#=\s][^=]*?)\s*=\s*(?:(?P<quote>["'])(?P<kept>.*)(?P=quote)|(?P<bare>.*?)(?:\s#.*)?)\s*""")


def env_values(text: str) -> dict[str, str]:
    """Keys and values of a settings text; blank lines, comments and lines without = are left out, and later lines win."""
    found = filter(None, map(SETTING.fullmatch, text.splitlines()))
    return {m["key"]: m["kept"] if m["quote"] else m["bare"].strip() for m in found}
