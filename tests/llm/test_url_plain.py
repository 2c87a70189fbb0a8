"""Every page of the given table judged again in plain Python: host, path and
rule by string operations, the score by numpy from the model's weights."""

from __future__ import annotations

import math
import struct

import numpy as np
import xxhash

from crease.llm import url_filter
from crease.llm.queries import QUERIES, URL_RULES

SF = "/root/testdata/sf0.01"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    stop = min([rest.index(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:stop]


def plain_rule(host, path):
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.name), default=None)


def plain_score(host, path, model):
    w = np.array(model.weights)
    at = []
    for tag, text in ((1, f"^{host}$"), (2, f"^{path}$")):
        seed = xxhash.xxh64_intdigest(struct.pack("<i", tag), 42)
        for n in model.sizes:
            for i in range(len(text) - n + 1):
                h = xxhash.xxh64_intdigest(text[i : i + n].encode(), seed)
                at.append((h - (1 << 64) if h >> 63 else h) % len(w))
    return 1 / (1 + math.exp(-(model.bias + w[at].sum() / max(1.0, math.sqrt(len(at))))))


def test_all_pages_again(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url")
    urls = {r["page_id"]: r["url"] for r in pages.collect()}
    model = url_filter.train(url_filter.labelled_by_rules(pages, URL_RULES))
    scored = {r["page_id"]: r for r in url_filter.judge_urls(pages, URL_RULES, model).collect()}
    got = {r["page_id"]: r for r in QUERIES["op10_url_filter"](spark, SF).collect()}
    assert set(got) == set(urls)
    by_rule = 0
    for k, url in urls.items():
        host, path = plain_parts(url)
        rule, score = plain_rule(host, path), plain_score(host, path, model)
        assert abs(scored[k]["score"] - score) < 1e-9, url
        want = rule.allow if rule else score < 0.5
        assert (got[k]["host"], got[k]["path"], got[k]["rule"], got[k]["verdict"]) == (host, path, rule and rule.name, "allow" if want else "block"), url
        by_rule += rule is not None
    assert 0 < by_rule < len(urls)
