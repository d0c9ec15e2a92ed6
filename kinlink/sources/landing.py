"""Files brought to the landing folder by the driver: only what is absent."""

from __future__ import annotations

import json
import os
import shutil
import time
import urllib.request
import zipfile


def conditional_download(url: str, dest: str, sleep: float = 0) -> bool:
    """Fetch url to dest unless dest exists; tells whether it did. A broken download leaves no file."""
    if os.path.exists(dest):
        return False
    os.makedirs(os.path.dirname(dest) or ".", exist_ok=True)
    part = dest + ".part"
    with urllib.request.urlopen(url) as r, open(part, "wb") as f:
        shutil.copyfileobj(r, f)
    os.replace(part, dest)
    if sleep:
        time.sleep(sleep)
    return True


def conditional_extract(archive: str, dest: str, wanted: str | None = None) -> bool:
    """Unpack archive to the folder dest unless dest (or the file wanted in it) exists; tells whether it did."""
    if not os.path.exists(archive):
        raise FileNotFoundError(archive)
    if os.path.exists(os.path.join(dest, wanted) if wanted else dest):
        return False
    with zipfile.ZipFile(archive) as z:
        z.extractall(dest)
    return True


def not_yet(codes: list[str], have: set[str], size: int = 50) -> list[list[str]]:
    """The codes not looked up so far, sorted, in chunks."""
    todo = sorted(set(codes) - have)
    return [todo[i : i + size] for i in range(0, len(todo), size)]


def save_responses(responses: list, folder: str, name: str) -> str:
    """Answers of a search kept as one JSON file, as json_hits reads them; gives its path."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"{name}.json")
    with open(path + ".part", "w", encoding="utf8") as f:
        json.dump(responses, f, indent=2)
    os.replace(path + ".part", path)
    return path
