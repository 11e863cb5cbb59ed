"""Sources and sinks under trouble: lists that shift, names that change their address, hosts asked in turn, broken lines, stopped writes."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from tessera.config import Config
from tessera.operators.search import RegistryError, UnsafeUrl
from tessera.schemas import RESULT
from tessera.sources import files, registry_api, web


@pytest.fixture
def registry():
    """A paged interface over a list that changes by change(requests so far)."""

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            with made.lock:
                made.requests += 1
                made.change(made.requests)
                rows = list(made.rows)
            self.send_response(200)
            self.end_headers()
            self.wfile.write(json.dumps({"size": len(rows), "values": [{"id": k, "field_2_s": f"Имя {k}"} for k in rows[asked["offset"] : asked["offset"] + asked["limit"]]]}).encode())

        def log_message(self, *args):
            pass

    made = HTTPServer(("127.0.0.1", 0), Handler)
    made.lock, made.requests, made.rows, made.change = threading.Lock(), 0, [str(k) for k in range(20)], lambda n: None
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield made
    made.shutdown()


def downloaded(spark, registry, page_size=3, attempts=3):
    config = Config(llm_key="k", registry_page_size=page_size, registry_page_delay=0.0, registry_attempts=attempts, registry_base_delay=0.0)
    return sorted(int(r["id"]) for r in registry_api.download(spark, config, url=f"http://127.0.0.1:{registry.server_port}/", pages_per_task="2").collect())


@pytest.mark.parametrize("page_size", [1, 2, 3, 7, 20, 200])
def test_a_list_at_rest_is_read_once(spark, registry, page_size):
    assert downloaded(spark, registry, page_size) == list(range(20))


@pytest.mark.parametrize("at", [2, 4, 6])
def test_a_row_inserted_while_pages_are_read_loses_none(spark, registry, at):
    registry.change = lambda n: registry.rows.insert(0, "99") if n == at else None
    assert downloaded(spark, registry) == [*range(20), 99]


def test_a_row_replaced_by_another_place_is_seen(spark, registry):
    """The size stays, the records shift."""

    def change(n):
        if n == 5:
            registry.rows.insert(0, registry.rows.pop())

    registry.change = change
    assert downloaded(spark, registry) == list(range(20))


def test_a_list_that_never_rests_is_an_error(spark, registry):
    registry.change = lambda n: registry.rows.insert(0, str(100 + n))
    with pytest.raises(RegistryError, match="changes"):
        downloaded(spark, registry, attempts=2)


def address(*ips):
    return [(2, 1, 6, "", (ip, 0)) for ip in ips]




def test_a_name_that_changes_its_address_is_connected_to_the_checked_one(monkeypatch):
    answers = [address("93.184.216.34"), address("127.0.0.1")]
    connected = []

    def connect(place, timeout):
        connected.append(place)
        raise OSError("no network")

    monkeypatch.setattr(web.socket, "create_connection", connect)
    with pytest.raises(OSError, match="no network"):
        web.fetch_html("http://site.example.org/x", resolve=lambda host, port: answers.pop(0))
    assert connected == [("93.184.216.34", 80)] and len(answers) == 1
    for found in (address("127.0.0.1"), address("93.184.216.34", "10.0.0.1"), [], address("no address")):
        with pytest.raises(UnsafeUrl):
            web.fetch_html("https://site.example.org/x", resolve=lambda host, port, found=found: found)
    with pytest.raises(UnsafeUrl):
        web.fetch_html("file:///etc/passwd")
    assert len(connected) == 1


@pytest.fixture
def site(monkeypatch):
    """A local site that stands for a public host."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            status, headers, body = made.pages[self.path]
            made.hosts.append(self.headers["Host"])
            self.send_response(status)
            for k, v in headers.items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    made = HTTPServer(("127.0.0.1", 0), Handler)
    made.pages, made.hosts = {}, []
    threading.Thread(target=made.serve_forever, daemon=True).start()
    real = web.socket.create_connection
    monkeypatch.setattr(web.socket, "create_connection", lambda place, timeout: real(("127.0.0.1", made.server_port), timeout))
    yield made
    made.shutdown()


def test_pages_redirects_and_limits(site):
    html = {"Content-Type": "text/html; charset=windows-1251"}
    site.pages = {
        "/a?x=1": (302, {"Location": "/b"}, b""), "/b": (200, html, "Дом".encode("cp1251")), "/pdf": (200, {"Content-Type": "application/pdf"}, b"x"), "/long": (200, html, b"x" * 300_000), "/gone": (404, html, b"x"),
        "/loop": (301, {"Location": "/loop"}, b""), "/inside": (302, {"Location": "http://inside.example.org/"}, b""),
    }
    resolve = lambda host, port: address("10.0.0.1" if host.startswith("inside") else "93.184.216.34")
    get = lambda path, **more: web.fetch_html(f"http://site.example.org{path}", resolve=resolve, **more)
    assert get("/a?x=1") == "Дом" and get("/pdf") == "" and len(get("/long", most=200_000)) in range(65_536, 200_001)
    for path, error in (("/gone", OSError), ("/loop", OSError), ("/inside", UnsafeUrl)):
        with pytest.raises(error):
            get(path)
    assert set(site.hosts) == {"site.example.org"}


def test_a_host_is_asked_by_one_task(spark):
    urls = spark.createDataFrame([(f"https://h{i % 5}.example.org/{i}",) for i in range(40)] * 2 + [("https://bad.example.org/",), (None,)], "url string").repartition(8)

    def fetch(url, timeout, most):
        from pyspark import TaskContext

        if "bad" in url:
            raise OSError
        return str(TaskContext.get().partitionId())

    rows = web.pages_of(urls, Config(llm_key="k"), fetch, pause=0.0).collect()
    by_host = {}
    for r in rows:
        by_host.setdefault(r["url"].split("/")[2], set()).add(r["html"])
    assert len(rows) == 40 and len(by_host) == 5 and all(len(tasks) == 1 for tasks in by_host.values())


def results(spark, n, fail=False):
    error = F.raise_error(F.lit("stopped")).cast("string") if fail else F.lit("e")
    columns = [F.col("id").cast("string").alias("id"), F.lit("n").alias("name"), F.lit("person").alias("entity_type"), F.lit("failed").alias("status"), F.lit(1).cast("long").alias("attempts"), error.alias("error"), F.lit(None).cast(RESULT).alias("result"), F.col("id").alias("row_no")]
    return spark.range(n).repartition(3).select(*columns)


def test_a_stopped_write_leaves_the_old_file(spark, tmp_path, monkeypatch):
    path = tmp_path / "r.jsonl"
    files.write_results(results(spark, 5), str(path))
    before = path.read_text()
    with pytest.raises(Exception, match="stopped"):
        files.write_results(results(spark, 3, fail=True), str(path))
    assert path.read_text() == before and before.count("\n") == 5
    # A stop after the parts were written, before the file took the old one's place.
    (tmp_path / "r.jsonl.whole").write_text("half")
    files.write_results(results(spark, 2), str(path))
    assert path.read_text().count("\n") == 2 and sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["r.jsonl"]


def test_a_broken_line_is_named(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    files.write_results(results(spark, 30), str(path))
    assert files.read_results(spark, str(path)).count() == 30
    lines = path.read_text().split("\n")
    path = tmp_path / "broken.jsonl"
    path.write_text("\n".join([*lines[:10], "", " \t", *lines[10:20], '{"id": "x", ', *lines[20:25], "[1", *lines[25:]]))
    with pytest.raises(ValueError, match="line 23 is no result"):
        files.read_results(spark, str(path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        with pytest.raises(ValueError, match="line 23 is no result"):
            files.read_results(spark, str(path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
