"""Stream source paths."""

from __future__ import annotations


def stream_path(path: str) -> str:
    """A file-source path for a landing folder or a single Parquet file.

    The file source wants a folder or a glob; a single file is given as a glob
    that matches only itself (last character as a one-letter class).
    """
    p = path.rstrip("/")
    if p.endswith(".parquet") and p[-1].isalnum():
        return f"{p[:-1]}[{p[-1]}]"
    return p
