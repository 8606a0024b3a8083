"""Fetching what the readers read: repositories, files and feeds, each kept so that a second run needs no network.

These run where they are called, on the driver or an operator's machine, into a folder that all machines share.
"""

from __future__ import annotations

import os
import subprocess
import tempfile
import urllib.request
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from granary.sources import jsonl


def repository(url: str, folder: str, shallow: bool = True, run: Callable[..., object] = subprocess.run) -> bool:
    """Clone url into folder unless it is there; whether it was cloned. A clone that fails is an error."""
    if os.path.exists(folder):
        return False
    os.makedirs(os.path.dirname(os.path.abspath(folder)), exist_ok=True)
    run(["git", "clone", *(["--depth", "1"] if shallow else []), "--", url, folder], check=True, capture_output=True)
    return True


def commit_of(folder: str) -> str:
    """The commit a cloned folder stands at; "unknown" where there is none."""
    found = subprocess.run(["git", "-C", folder, "rev-parse", "HEAD"], capture_output=True, text=True)
    return found.stdout.strip() if found.returncode == 0 else "unknown"


def download(url: str, path: str, timeout: float = 120.0) -> bool:
    """Download url to path unless it is there, whole or not at all; whether it was downloaded."""
    if os.path.exists(path):
        return False
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, part = tempfile.mkstemp(dir=folder)
    try:
        with urllib.request.urlopen(url, timeout=timeout) as response, os.fdopen(handle, "wb") as out:
            while block := response.read(1 << 20):
                out.write(block)
        os.replace(part, path)
    except BaseException:
        os.unlink(part)
        raise
    return True


def json_feed(spark: SparkSession, url: str, path: str, schema: str) -> DataFrame:
    """A JSON feed, downloaded once to path, as rows of the schema."""
    download(url, path)
    return jsonl.json_file(spark, path, schema)


def environment(path: str, into: dict[str, str] | None = None) -> dict[str, str]:
    """KEY=value lines of a file set in the environment where they aren't yet; what was set. A missing file sets nothing."""
    into = os.environ if into is None else into
    found: dict[str, str] = {}
    if not os.path.exists(path):
        return found
    with open(path, encoding="utf-8") as lines:
        for line in map(str.strip, lines):
            key, sign, value = line.partition("=")
            key = key.strip()
            if sign and key and not line.startswith("#") and key not in into:
                found[key] = into[key] = value.strip().strip("\"'")
    return found
