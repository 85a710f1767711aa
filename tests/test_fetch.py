"""Downloads from a server of this test's own."""

from __future__ import annotations

import collections
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pytest

from terrazzo.sources import fetch, raster

GOOD = raster.encode(raster.Raster(np.ones((1, 40, 30), np.uint16)), block=16)
SEEN: collections.Counter = collections.Counter()


class Server(BaseHTTPRequestHandler):
    def do_GET(self):  # noqa: N802
        path = self.path.split("?")[0]
        SEEN[path] += 1
        status = {"/lost.tif": 404, "/down.tif": 503}.get(path, 500 if path == "/late.tif" and SEEN[path] < 3 else 403 if path == "/mail.tif" and "email=a%40b.example" not in self.path else 200)
        body = GOOD[: len(GOOD) // 2] if path == "/cut.tif" else GOOD
        self.send_response(status)
        self.send_header("Content-Length", str(len(body)))
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *a):
        pass


@pytest.fixture(scope="module")
def address():
    server = ThreadingHTTPServer(("127.0.0.1", 0), Server)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_download(spark, address):
    names = ["good", "late", "lost", "down", "cut", "mail"]
    rows = [(n, "pan", f"{address}/{n}.tif") for n in names] + [("none", "pan", None), ("bad", "pan", "no://where")]
    out = fetch.download(spark.createDataFrame(rows, "id string, band string, url string"), unit=0.01, email="a@b.example").collect()
    got = {r.id: (r.content is not None and bytes(r.content) == GOOD, r.attempts, r.error) for r in out}
    assert got["good"] == (True, 1, None) and got["mail"] == (True, 1, None) and got["late"] == (True, 3, None)
    assert got["lost"] == (False, 1, "status 404") and got["down"] == (False, 3, "status 503")
    assert got["cut"] == (False, 3, "not a whole GeoTIFF") and got["none"] == (False, 0, "no address") and got["bad"][1] == 3
    assert [fetch.pause(k) for k in (1, 2, 12, 50)] == [5, 10, 60, 60]
    with pytest.raises(ValueError, match="url"):
        fetch.download(spark.createDataFrame([("x",)], "id string"))
