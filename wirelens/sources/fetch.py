"""Fetching over HTTP as a batch stage: url rows in, one log row for each out.

Nothing here runs unless a plan asks for live sources.  A failed fetch is a
row with an error type, never a failed task.
"""

from __future__ import annotations

import socket
import ssl
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.constants import BACKOFF, CONNECT_TRIES, FETCH_BUDGET, FETCH_TIMEOUT
from ..functions.scoring import workers

HEADERS = {"User-Agent": "Mozilla/5.0 (compatible; wirelens)", "Accept": "text/html,application/xhtml+xml,application/xml;q=0.9,*/*;q=0.8", "Accept-Language": "en-US,en;q=0.9"}

#: (status, body) of a url; raises TimeoutError, ssl.SSLError or ConnectionError
Get = Callable[[str, dict, float, bool], tuple[int, str]]


def headers() -> dict[str, str]:
    return dict(HEADERS)


def http_get(url: str, head: dict, timeout: float, verify: bool) -> tuple[int, str]:
    context = None if verify else ssl._create_unverified_context()
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=head), timeout=timeout, context=context) as r:
            return r.status, r.read().decode(r.headers.get_content_charset() or "utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, ""
    except urllib.error.URLError as e:
        if isinstance(e.reason, (ssl.SSLError, TimeoutError)):
            raise e.reason from e
        raise ConnectionError(str(e.reason)) from e
    except socket.timeout as e:
        raise TimeoutError(str(e)) from e


def error_of(status: int) -> str | None:
    return None if status == 200 else {403: "403", 404: "404"}.get(status, "http_error")


def fetch_one(url: str, get: Get = http_get, render: Callable[[str], str | None] | None = None, unverified: bool = False, sleep: Callable[[float], None] = time.sleep) -> dict:
    """status, body, error_type and how it was fetched.  Connections are tried CONNECT_TRIES times; a certificate error is tried once without verification where that is allowed; a 403 is rendered where a renderer is given."""
    out = {"status": 0, "body": "", "error_type": None, "used_render": False, "tls_fallback": False}
    for attempt in range(CONNECT_TRIES):
        try:
            try:
                status, body = get(url, headers(), FETCH_TIMEOUT, True)
            except ssl.SSLError:
                if not unverified:
                    return out | {"error_type": "ssl"}
                out["tls_fallback"] = True
                status, body = get(url, headers(), FETCH_TIMEOUT, False)
        except TimeoutError:
            return out | {"error_type": "timeout"}
        except ssl.SSLError:
            return out | {"error_type": "ssl"}
        except ConnectionError:
            if attempt + 1 < CONNECT_TRIES:
                sleep(BACKOFF[min(attempt, len(BACKOFF) - 1)])
                continue
            return out | {"error_type": "dns"}
        if status == 403 and render:
            page = render(url)
            return out | ({"status": 200, "body": page, "used_render": True} if page is not None else {"status": 403, "error_type": "render_failed"})
        return out | {"status": status, "body": body if status == 200 else "", "error_type": error_of(status)}
    return out


LOG = "status int, body string, error_type string, used_render boolean, tls_fallback boolean"
UNFINISHED = "unfinished"


#: Seconds between two requests to one host.
HOST_GAP = 0.1


def fetch(
    urls: DataFrame, get: Get = http_get, render=None, carry: tuple[str, ...] = (), budget: float = FETCH_BUDGET, unverified: bool = False, until: float | None = None, gap: float = HOST_GAP,
) -> DataFrame:
    """A log row for each row of urls (url, firm_name and what is carried); spread over as many tasks as the count asks for.

    One deadline holds for all tasks, whenever they start: ``until`` in seconds
    since 1970, or ``budget`` seconds from this call.  Rows that are not begun
    by then are logged as unfinished; what was fetched stays.  A host's urls
    are in one task, which asks its hosts in turns and leaves ``gap`` seconds
    between two requests to the same one.
    """
    until = time.time() + budget if until is None else until
    n = workers(urls.count())
    columns = ["url", "firm_name", *carry]
    kept = urls.select(*columns)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^[^:/?#]*:?//([^/?#]*)", 1))
    turn = F.row_number().over(W.partitionBy("ask_host").orderBy("url"))
    dealt = kept.withColumn("ask_host", host).repartition(n, "ask_host").withColumn("ask_turn", turn).sortWithinPartitions("ask_turn", "ask_host")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        late = {"status": 0, "body": "", "error_type": UNFINISHED, "used_render": False, "tls_fallback": False}
        asked: dict[str, float] = {}

        def one(url: str, of: str) -> dict:
            wait = asked.get(of, 0) + gap - time.monotonic()
            if wait > 0 and time.time() < until:
                time.sleep(min(wait, max(0, until - time.time())))
            if time.time() >= until:
                return late
            got = fetch_one(url, get, render, unverified)
            asked[of] = time.monotonic()
            return got

        for part in parts:
            rows = [one(u, h) for u, h in zip(part["url"], part["ask_host"], strict=True)]
            yield pd.concat([part[columns].reset_index(drop=True), pd.DataFrame(rows, columns=list(late))], axis=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return dealt.mapInPandas(run, f"{schema}, {LOG}")


def unfinished(log: DataFrame) -> DataFrame:
    """Sources that the time budget left out."""
    return log.where(f"error_type = '{UNFINISHED}'").select("firm_name").distinct()


def rendered(urls: DataFrame, render: Callable[[str], str | None], carry: tuple[str, ...] = ()) -> DataFrame:
    """Pages as a renderer gives them; a failure is a log row."""
    columns = ["url", "firm_name", *carry]
    kept = urls.select(*columns)

    def one(url: str) -> dict:
        try:
            page = render(url)
        except Exception:  # a renderer's fault is a failed page
            page = None
        return {"status": 200 if page else 0, "body": page or "", "error_type": None if page else "render_failed", "used_render": True, "tls_fallback": False}

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.concat([part[columns].reset_index(drop=True), pd.DataFrame([one(u) for u in part["url"]], columns=["status", "body", "error_type", "used_render", "tls_fallback"])], axis=1)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.repartition(workers(urls.count())).mapInPandas(run, f"{schema}, {LOG}")


def paged(ask: Callable[[dict], dict], size: int = 100) -> Iterator[dict]:
    """Answer pages of a cursor API, one after another, until there are no more; its errors go to the caller."""
    body: dict = {"page_size": size}
    while True:
        page = ask(body)
        yield page
        if not page.get("has_more"):
            return
        body = {"page_size": size, "start_cursor": page.get("next_cursor")}
