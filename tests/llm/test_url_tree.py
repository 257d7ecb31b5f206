"""The radix tree of url templates against a plain tree that goes level by level in one process."""

import random
import re
import time
from collections import defaultdict

from collidex.llm.url_filter import url_filter

RULES = [("block", "net/bad/"), ("allow", "net/ok/"), ("block", "h1.net/a/b/"), ("allow", "h2.net/c/")]


def split(url):
    if not url or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
    return host.lower(), path


def shape(path):
    def kind(s):
        s = re.sub(r"^[0-9]+(?=\.|$)", "<n>", s)
        return re.sub(r"^(?=[^.]*[0-9])[0-9a-f-]{8,}(?=\.|$)", "<x>", s)
    return "/".join(kind(s) for s in path.split("/") if s)


def plain(urls, rules, max_children=20, z=2.0, weight=4.0, reject=0.9):
    rows, leaves = [], defaultdict(lambda: [0, 0])
    for u in urls:
        host, path = split(u)
        fit = [(len(r), v, r) for v, r in rules if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0])) and path.startswith("/" + r.split("/", 1)[1])]
        verdict = max(fit)[1] if fit else None
        rows.append((host, path, max(fit)[2] if fit else None, verdict))
        leaf = leaves[host, shape(path)]
        leaf[0] += verdict is not None
        leaf[1] += verdict == "block"
    live, template = {k: "" for k in leaves}, {}
    for level in range(10_000):
        kids = defaultdict(lambda: defaultdict(list))
        for k, t in live.items():
            kids[k[0], t][k[1].split("/")[level]].append(k)
        after = {}
        for (host, t), by in kids.items():
            l, b = ({s: sum(leaves[k][i] for k in ks) for s, ks in by.items()} for i in (0, 1))
            share = sum(b.values()) / max(sum(l.values()), 1)
            bare = sum(n == 0 for n in l.values())
            for s, ks in by.items():
                n, name = max(l[s], 1), s
                if l[s] and len(by) > 1 and abs(b[s] / n - share) <= z * (share * (1 - share) / n) ** 0.5 + 1e-9:
                    name = "*"
                elif not l[s] and bare > max_children:
                    name = "?"
                for k in ks:
                    if k[1].count("/") == level:
                        template[k] = f"{t}/{name}"
                    else:
                        after[k] = f"{t}/{name}"
        live = after
        if not live:
            break

    def total(key):
        out = defaultdict(lambda: [0, 0])
        for k, (l, b) in leaves.items():
            out[key(k)][0] += l
            out[key(k)][1] += b
        return out

    def purity(lb, prior):
        return (lb[1] + weight * prior) / (lb[0] + weight)

    def domain(k):
        return ".".join(k[0].split(".")[-2:]), k[1]

    def own(k):
        return k[0], template[k]

    first, second, third = total(lambda k: 0), total(domain), total(own)
    out = []
    for host, path, rule, verdict in rows:
        k = (host, shape(path))
        p = purity(third[own(k)], purity(second[domain(k)], min(purity(first[0], 0.0), 0.5)))
        out.append((host, path, rule, verdict or ("block" if p > reject else "allow"), host + template[k], round(p, 9)))
    return out


def judged(spark, urls, **kw):
    df = url_filter(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), RULES, **kw)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict, r.template, round(r.purity, 9)) for r in df.collect()}
    return [got[i] for i in range(len(urls))]


def test_radix_tree_equals_a_plain_tree(spark):
    rng = random.Random(11)
    seg = ["a", "b", "bad", "ok", "c", "d", "12", "99", "deadbeef01", "x.html", "é"]
    urls = [None, "", "nothing", "http://h1.net", "http://h1.net/", "http://h1.net//a", "http://h1.net/a/b?x=/bad/"]
    for _ in range(800):
        host = rng.choice(["h1.net", "h2.net", "sub.h1.net", "H3.org", "h4.com"])
        if rng.random() < 0.3:      # nested and forked chains
            path = "/".join(["a", "b"] * rng.randint(1, 2) + rng.choices(seg, k=rng.randint(0, 2)))
        else:
            path = "/".join(rng.choices(seg, weights=[4, 3, 6, 5, 2, 1, 4, 2, 2, 1, 1], k=rng.randint(0, 5)))
        urls.append(f"http://{host}/{path}")
    for kw in ({}, {"max_children": 2, "reject": 0.6}):
        assert judged(spark, urls, **kw) == plain(urls, RULES, **kw)


def test_paths_of_a_thousand_segments(spark):
    trap = ["trap", "calendar"] * 500
    urls = [f"http://t.org/{'/'.join(trap[:n])}" for n in range(1, 1001, 7)]        # each is the start of the next
    urls += [f"http://t.org/{'/'.join(trap)}/{x}/1" for x in ("bad", "ok", "end")] + ["http://u.net/" + "bad/" * 1000, "http://u.net/" + "bad/" * 999 + "ok"]
    start = time.time()
    got = judged(spark, urls)
    assert time.time() - start < 60
    assert got == plain(urls, RULES)
