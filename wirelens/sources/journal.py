"""A journal of calls to services, so that no answered call is made twice.

An answer is a small JSON file named by the hash of what was asked, written
aside and moved into place, in a folder that all executors share.  A task that
runs again, or a run that is started again over the same folder, finds it and
does not ask.  What is asked but not answered leaves nothing.  Between the
answer and its file lies the only moment in which a lost executor makes a call
happen twice; services that know idempotency keys can be given the hash.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow.fs as pafs


def key_of(*parts: object) -> str:
    return hashlib.sha256("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")).hexdigest()


class Journal:
    """Answers below a folder (a path or an address of a file system)."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def _at(self) -> tuple[pafs.FileSystem, str]:
        return pafs.FileSystem.from_uri(self.folder) if ":" in self.folder.split("/", 1)[0] else (pafs.LocalFileSystem(), self.folder)

    def get(self, key: str) -> dict | None:
        fs, root = self._at()
        path = f"{root}/{key[:2]}/{key}.json"
        if fs.get_file_info(path).type == pafs.FileType.NotFound:
            return None
        with fs.open_input_stream(path) as f:
            return json.loads(f.read())

    def put(self, key: str, answer: dict) -> None:
        fs, root = self._at()
        fs.create_dir(f"{root}/{key[:2]}", recursive=True)
        aside = f"{root}/{key[:2]}/{uuid.uuid4().hex}.part"
        with fs.open_output_stream(aside) as f:
            f.write(json.dumps(answer).encode())
        fs.move(aside, f"{root}/{key[:2]}/{key}.json")

    def once(self, key: str, call: Callable[[], dict | None]) -> dict | None:
        """The answer under a key; asked for, and written down, only where there is none.  None, which is no answer, is not written."""
        known = self.get(key)
        if known is None and (known := call()) is not None:
            self.put(key, known)
        return known


def in_flight(work: Callable, items: Iterable, many: int) -> Iterator:
    """work(item) for each item, in order, with at most ``many`` calls begun and not yet given out."""
    with ThreadPoolExecutor(many) as pool:
        begun = []
        for item in items:
            begun.append(pool.submit(work, item))
            if len(begun) >= many:
                yield begun.pop(0).result()
        for b in begun:
            yield b.result()
