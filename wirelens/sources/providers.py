"""What a run talks to besides web pages: language models, the sink, a renderer.

Each is a plain callable.  It is named as ``module:function`` or, for models
and sinks, as the address of an HTTP service; keys come from the environment
(WIRELENS_MODEL_KEY, WIRELENS_SINK_KEY) and never from arguments.
"""

from __future__ import annotations

import importlib
import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable

from ..functions.constants import REPLY_TOKENS, SINK_TIMEOUT


def _post(url: str, body: dict, key: str | None, timeout: float) -> dict:
    head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {key}", "x-api-key": key} if key else {})
    with urllib.request.urlopen(urllib.request.Request(url, json.dumps(body).encode(), head), timeout=timeout) as r:
        return json.loads(r.read())


class HttpModel:
    """A chat service: (system, prompt) -> (reply, tokens in, tokens out)."""

    def __init__(self, url: str, model: str, key: str | None = None, timeout: float = 120, post: Callable = _post):
        self.url, self.model, self.key, self.timeout, self.post = url, model, key, timeout, post

    def __call__(self, system: str, prompt: str) -> tuple[str, int, int]:
        got = self.post(self.url, {"model": self.model, "max_tokens": REPLY_TOKENS, "system": system, "messages": [{"role": "user", "content": prompt}]}, self.key, self.timeout)
        used = got.get("usage", {})
        if "choices" in got:
            return got["choices"][0]["message"]["content"], used.get("prompt_tokens", 0), used.get("completion_tokens", 0)
        return "".join(part.get("text", "") for part in got["content"]), used.get("input_tokens", 0), used.get("output_tokens", 0)


class HttpSink:
    """A service that takes one document a request: document -> its id, or None where it was refused."""

    def __init__(self, url: str, key: str | None = None, timeout: float = SINK_TIMEOUT, post: Callable = _post):
        self.url, self.key, self.timeout, self.post = url, key, timeout, post

    def __call__(self, document: str) -> str | None:
        try:
            return self.post(self.url, json.loads(document), self.key, self.timeout).get("id")
        except (urllib.error.URLError, TimeoutError, ValueError):
            return None


def asker(url: str, post: Callable = _post) -> Callable[[dict], dict]:
    """For fetch.paged: asks a cursor service; its errors go to the caller."""
    key = os.environ.get("WIRELENS_SINK_KEY")
    return lambda body: post(url, body, key, SINK_TIMEOUT)


def load(name: str) -> Callable:
    """The callable that ``module:function`` names."""
    module, _, attribute = name.partition(":")
    if not attribute:
        raise ValueError(f"{name!r} is no module:function")
    return getattr(importlib.import_module(module), attribute)


def model(name: str | None, which: str = "") -> Callable | None:
    if not name:
        return None
    return HttpModel(name, which, os.environ.get("WIRELENS_MODEL_KEY")) if name.startswith(("http://", "https://")) else load(name)


def sink(name: str | None) -> Callable | None:
    """None where no sink is named; a service without a key is refused before anything runs."""
    if not name:
        return None
    if name.startswith(("http://", "https://")):
        key = os.environ.get("WIRELENS_SINK_KEY")
        if not key:
            raise ValueError("the sink is not configured: WIRELENS_SINK_KEY is not set")
        return HttpSink(name, key)
    return load(name)
