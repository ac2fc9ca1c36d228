"""Reformatting configuration in YAML, merged over defaults."""

from __future__ import annotations

from copy import deepcopy

DEFAULTS = {
    "encoding": {"fixes": {}},
    "patterns": {"skip": ["*session.txt", "*sessionlangeng.txt"]},
    "quality": {"min_title_length": 3, "min_body_length": 100, "min_author_length": 5, "max_encoding_issues": 50},
}


def merge(base: dict, over: dict | None) -> dict:
    """encoding.fixes are updated, lists replaced, unknown quality keys ignored."""
    out = deepcopy(base)
    over = over or {}
    out["encoding"]["fixes"].update((over.get("encoding") or {}).get("fixes") or {})
    for k, v in (over.get("patterns") or {}).items():
        out["patterns"][k] = v
    for k, v in (over.get("quality") or {}).items():
        if k in out["quality"]:
            out["quality"][k] = v
    return out


def load(text: str) -> dict:
    import yaml

    return merge(DEFAULTS, yaml.safe_load(text))


def dump(config: dict) -> str:
    import yaml

    return yaml.safe_dump(config, allow_unicode=True, sort_keys=True)
