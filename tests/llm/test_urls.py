import re

import pytest

from docledger.llm import url_templates


@pytest.fixture
def judged(spark):
    def run(urls, labels=(), **parameters):
        pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, n string")
        known = spark.createDataFrame(list(labels), "page_id long, bad boolean")
        return {r["page_id"]: r for r in url_templates.judge(pages, known, **parameters).collect()}

    return run


def test_rules_and_parts(judged):
    urls = [
        "http://A.Example.COM/en/1", "http://www.example.com/en/2?x", "http://x.www.example.com/en/", "http://b.com", "http://b.com/",
        "https://x.net/es/9#a", "https://net/fr/", "https://xnet/fr/", None, "", "no scheme/en/", "://", "x://h?q://z/", "http://É.com/É/1",
        "http://com/en", "ftp://u@h.net:80/es/", "http://h\nx.net/fr/",
    ]
    found = judged(urls)
    for i, url in enumerate(urls):
        m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
        host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
        path = m[2] if m else ""
        fits = [(len(r), r, v) for v, r in url_templates.RULES for own, start in [r.split("/", 1)] if (host == own or host.endswith("." + own)) and path.startswith("/" + start)]
        assert (found[i]["host"], found[i]["path"]) == (host, path)
        assert found[i]["rule"] == (max(fits)[1] if fits else None)
        assert found[i]["verdict"] == (max(fits)[2] if fits else "allow")


def test_bad_templates_are_rejected(judged):
    urls = [f"http://h.org/good/{i}" for i in range(60)] + [f"http://h.org/bad/{i}.html" for i in range(60)] + [f"http://h.org/one-{i}x/" for i in range(9)]
    labels = [(i, False) for i in range(0, 60, 2)] + [(i, True) for i in range(60, 120, 2)]
    found = judged(urls, labels)
    assert {found[i]["verdict"] for i in range(60)} == {"allow"} and {found[i]["verdict"] for i in range(60, 120)} == {"block"}
    assert found[61]["template"] == "/bad/*" and found[125]["template"] == "/*"


def test_similar_branches_are_merged(judged):
    urls = [f"http://h.org/{x}/{i}" for x in ("a", "b", "c") for i in range(30)]
    labels = [(i, i % 3 == 0) for i in range(60)] + [(i, True) for i in range(60, 90)]
    found = judged(urls, labels)
    assert found[0]["branch"] == found[30]["branch"] == "/~0" and found[60]["branch"] == "/~1"


def test_rare_segments_are_generalised(judged):
    urls = [f"http://h.org/{w}" for w in "one two three four five six seven".split()] + ["http://h.org/many"] * 5
    found = judged(urls)
    assert {found[i]["template"] for i in range(7)} == {"/*"} and found[8]["template"] == "/many"


def test_few_labels_do_not_reject(judged):
    assert judged(["http://h.org/x"] * 5, [(0, True), (0, None), (1, True), (7, False), (None, True)] + [(9, False)] * 3)[0]["verdict"] == "allow"


def test_empty_table(judged):
    assert judged([]) == {}


def test_sections_of_a_large_host_stay(judged):
    """Many small sections of one host, and branches that part at the fifth level, are judged by their own labels."""
    names = [f"{a}{b}" for a in "abcdefgh" for b in "klmnopqrs"]
    urls = [f"http://h.org/{x}/{i}" for x in names for i in range(20)]
    urls += [f"http://deep.org/one/two/three/four/{x}/{i}" for x in ("fine", "foul") for i in range(30)]
    bad = {i for i, u in enumerate(urls) if "/ak/" in u or "/foul/" in u}
    found = judged(urls, [(i, i in bad) for i in range(len(urls))])
    assert found[0]["template"] == "/ak/*" and {i for i in found if found[i]["verdict"] == "block"} == bad


def test_similar_steps_do_not_chain(judged):
    """Eleven siblings of 10 labels each, 0 to 10 of them bad: the worst are rejected, the cleanest not, one without labels is apart."""
    urls = [f"http://h.org/{x}/{i}" for x in "abcdefghijk" for i in range(10)] + [f"http://h.org/new/{i}" for i in range(10)]
    found = judged(urls, [(10 * s + i, i < s) for s in range(11) for i in range(10)])
    verdicts = [found[10 * s]["verdict"] for s in range(12)]
    assert verdicts[10] == "block" and {*verdicts[:4], verdicts[11]} == {"allow"}
    assert found[110]["branch"] not in {found[10 * s]["branch"] for s in range(11)}
