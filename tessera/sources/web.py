"""Official sites: fetched under a guard, never from private hosts, never beyond a bounded size.

A name is resolved once for each request, and the connection goes to an address of that answer, so a name that leads elsewhere a
moment later leads nowhere. All sites of a host are fetched by one task, one after the other.
"""

from __future__ import annotations

import http.client
import ipaddress
import socket
import ssl
import time
from urllib.parse import urljoin, urlparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.urls import hostname
from tessera.operators.search import UnsafeUrl

CHUNK = 64 * 1024
REDIRECTS = (301, 302, 303, 307, 308)
MOST_REDIRECTS = 10
#: Seconds between two requests to a host.
PAUSE = 0.2


def public_addresses(host: str | None, resolve=socket.getaddrinfo) -> list[str]:
    """The addresses of a host if every one is globally routable, else none."""
    if not host:
        return []
    try:
        found = [x[4][0] for x in resolve(host, None)]
        return list(dict.fromkeys(found)) if all(ipaddress.ip_address(a.partition("%")[0]).is_global for a in found) else []
    except (OSError, UnicodeError, ValueError):
        return []


def is_public_host(host: str | None, resolve=socket.getaddrinfo) -> bool:
    """Whether every address of the host is globally routable; a host that does not resolve is not."""
    return bool(public_addresses(host, resolve))


def is_public_url(url: str, resolve=socket.getaddrinfo) -> bool:
    try:
        parsed = urlparse(url)
        return parsed.scheme in ("http", "https") and is_public_host(parsed.hostname, resolve)
    except ValueError:
        return False


def connection_to(url: str, timeout: float, resolve=socket.getaddrinfo) -> http.client.HTTPConnection:
    """A connection to an address that was checked; the name serves for the certificate and the Host header only."""
    parsed = urlparse(url)
    addresses = public_addresses(parsed.hostname, resolve) if parsed.scheme in ("http", "https") else []
    if not addresses:
        raise UnsafeUrl(url)
    secure = parsed.scheme == "https"
    made = http.client.HTTPConnection(parsed.hostname, parsed.port or (443 if secure else 80), timeout=timeout)
    made.sock = socket.create_connection((addresses[0], made.port), timeout)
    if secure:
        made.sock = ssl.create_default_context().wrap_socket(made.sock, server_hostname=parsed.hostname)
        made.default_port = 443
    return made


def read_body(chunks, most: int) -> bytes:
    """Chunks up to the one that would cross the limit."""
    body = b""
    for chunk in chunks:
        if len(body) + len(chunk) > most:
            break
        body += chunk
    return body


def fetch_html(url: str, timeout: float = 12.0, most: int = 2_000_000, resolve=socket.getaddrinfo) -> str:
    """The page's text, empty if it is no HTML. The guard asks before the request and before each redirect."""
    for _ in range(MOST_REDIRECTS + 1):
        made = connection_to(url, timeout, resolve)
        try:
            parsed = urlparse(url)
            target = (parsed.path or "/") + (f"?{parsed.query}" if parsed.query else "")
            made.request("GET", target, headers={"User-Agent": "Mozilla/5.0 (compatible; entity-link-bot)", "Accept": "text/html"})
            answer = made.getresponse()
            if answer.status in REDIRECTS and answer.getheader("Location"):
                url = urljoin(url, answer.getheader("Location"))
                continue
            if answer.status >= 400:
                raise OSError(f"{url}: status {answer.status}")
            if "html" not in (answer.getheader("Content-Type") or "").lower():
                return ""
            raw = read_body(iter(lambda: answer.read(CHUNK), b""), most)
            return raw.decode(answer.headers.get_content_charset() or "utf-8", errors="replace")
        finally:
            made.close()
    raise OSError(f"{url}: too many redirects")


def pages_of(urls: DataFrame, config, fetch=fetch_html, pause: float = PAUSE) -> DataFrame:
    """url and html of distinct URLs; a site that fails has no row. Sites are fetched once for each run of the plan.

    The URLs of a host lie in one partition, in a row: no two tasks ask a host, and a task pauses before it asks one again.
    """
    timeout, most = config.crawler_timeout, config.crawler_max_bytes

    def work(batches):
        import pyarrow as pa

        last = None
        for batch in batches:
            found = []
            for url, host in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if host == last:
                    time.sleep(pause)
                last = host
                try:
                    found.append((url, fetch(url, timeout, most)))
                except Exception:
                    continue
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.string()) for k in (0, 1)], ["url", "html"])

    hosts = urls.select("url").distinct().withColumn("host", hostname(F.col("url")))
    return hosts.repartition("host").sortWithinPartitions("host", "url").mapInArrow(work, "url string, html string")
