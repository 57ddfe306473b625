from sluice.llm import secret_scan as scan

ORDINARY = [
    "src/main/java/com/example/app", "/usr/local/lib/python/site-packages", "www/static/css/main/theme/dark", "http=//example/docs/alpha/one/html",
    "-" * 40, "=" * 40, "/" * 40, "_" * 40, "+-" * 20, "internationalisationandlocalisation",
]
KEYS = ["Zq8Xv2LpR9kTw4YbN7dHs", "x9Kf-3Qz_Wv7RtB2mPj8LcYd", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYzQ3kT9vB"]


def test_paths_and_rulers_are_no_secrets(spark, given):
    rows = [(30_000 + k, f"before {w} after") for k, w in enumerate(ORDINARY + KEYS)]
    docs = given.select("doc_id", "text").unionByName(spark.createDataFrame(rows, "doc_id long, text string"))
    added = {r.doc_id: r.n_random for r in scan.digest(scan.scan(docs)).filter("doc_id >= 30000").collect()}
    assert [added[30_000 + k] for k in range(len(rows))] == [0] * len(ORDINARY) + [1] * len(KEYS)
