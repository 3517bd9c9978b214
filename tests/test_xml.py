"""One pass over articles against a tree walked field by field; entities within and beyond their budget."""

import random
import time
import xml.etree.ElementTree as ET

import pytest

from millrace.functions import xml

NAMES = ["license", "ext-link", "uri", "fig", "table-wrap", "caption", "graphic", "media", "inline-graphic", "supplementary-material", "body", "article-title", "journal-title", "article-id", "p", "math", "inline-formula", "disp-formula", "sec"]


def walked(text):
    """The fields by walks of the tree, as their definitions say."""
    try:
        root = ET.fromstring(text)
    except ET.ParseError as e:
        return {"ok": False, "error": str(e)[:300]}
    name = lambda e: e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""
    every = lambda top, *names: [e for e in top.iter() if name(e) in names]
    told = lambda e: "" if e is None else " ".join("".join(e.itertext()).split())
    href = lambda e: (e.get(xml.XLINK) or e.get("href") or "").strip()
    once = lambda values: list(dict.fromkeys(v for v in values if v))
    if name(root) != "article":
        return {"ok": False, "error": f"not_article:{name(root)}"}
    first = lambda n: told(next(iter(every(root, n)), None))
    licenses = every(root, "license")
    return {
        "ok": True, "error": None, "license_text": " ".join(map(told, licenses)), "license_urls": once(x for e in licenses for x in [href(e), *[href(u) or told(u) for u in every(e, "ext-link", "uri")]]),
        "captions": [c for c in (told(next(iter(every(e, "caption")), None)) for e in every(root, "fig", "table-wrap")) if c],
        "doi": next((told(e) for e in every(root, "article-id") if (e.get("pub-id-type") or "").lower() == "doi"), ""), "title": first("article-title"), "journal": first("journal-title"),
        "text_chars": len(told(root)), "body_chars": sum(len(told(b)) for b in every(root, "body")), "figures": len(every(root, "fig")), "tables": len(every(root, "table-wrap")),
        "formulas": len(every(root, "disp-formula", "inline-formula", "math")), "hrefs": once(href(e) for e in every(root, *xml.MEDIA)),
    }


def element(rng, depth):
    name = rng.choice(NAMES)
    name = rng.choice(["", "", "x:"]) + name
    attributes = rng.choice(["", "", ' href="u%d"' % rng.randrange(4), ' xlink:href=" v%d "' % rng.randrange(4), ' xlink:href="" href="w"', ' pub-id-type="DOI"', ' pub-id-type="pmid"'])
    inner = "".join(rng.choice(["t ", "\n  ", "é&amp;", "<!-- c -->", "<![CDATA[<d>]]>", "&e;", ""]) + (element(rng, depth - 1) if depth and rng.random() < 0.7 else "") for _ in range(rng.randrange(4)))
    return f"<{name}{attributes}>{inner}</{name}>"


def article(rng):
    body = "".join(element(rng, 4) for _ in range(rng.randrange(1, 6)))
    return f'<!DOCTYPE article [<!ENTITY e "ent <p>ity</p>">]><article xmlns:xlink="http://www.w3.org/1999/xlink" xmlns:x="http://x">{body}</article>'


def test_one_pass_equals_walks():
    rng = random.Random(3)
    for _ in range(600):
        text = article(rng)
        assert xml.parsed(text) == walked(text), text


@pytest.mark.parametrize("text", ["", "<article>", "<a/>", "<article>&nope;</article>", "<article><b></article>", "<article x='1' x='2'/>", "<article/>tail", "<!DOCTYPE article><article>&nope;</article>", "<x:article/>", "not xml"])
def test_errors(text):
    got, want = xml.parsed(text), walked(text)
    assert got["ok"] == want["ok"] is False and got["error"].split(":")[0].split(" &")[0] == want["error"].split(":")[0].split(" &")[0]


def bomb(levels, times):
    names = [f"e{i}" for i in range(levels)]
    return '<!DOCTYPE article [<!ENTITY e0 "0123456789">' + "".join(f'<!ENTITY {b} "{f"&{a};" * times}">' for a, b in zip(names, names[1:])) + f"]><article><body><p>&{names[-1]};</p></body></article>"


def test_entities(spark):
    small = '<!DOCTYPE article [<!ENTITY who "A. Author"><!ENTITY by "by &who; and others">]><article><front><article-title>T &by;</article-title></front><body>&who;</body></article>'
    assert xml.parsed(small)["title"] == "T by A. Author and others" and xml.parsed(small)["body_chars"] == 9
    assert xml.parsed(bomb(3, 10))["body_chars"] == 1000
    at = time.time()
    deep = xml.parsed(bomb(12, 10))
    wide = xml.parsed('<!DOCTYPE article [<!ENTITY e "' + "x" * 5000 + '">]><article><body>' + "&e;" * 20_000 + "</body></article>")
    inside = xml.parsed('<!DOCTYPE article [<!ENTITY e "' + "x" * 5000 + '">]><article><body>' + '<p a="&e;"/>' * 20_000 + "</body></article>")
    assert [d["ok"] for d in (deep, wide, inside)] == [False] * 3 and "expand" in deep["error"] and "expand" in wide["error"] and time.time() - at < 20
    with pytest.raises(ValueError, match="expand"):
        xml.rewritten(bomb(12, 10), {}, "")
    rows = spark.createDataFrame([(small,), (bomb(12, 10),), (None,)], "t string").select(xml.parse_xml("t").alias("a"))
    assert [r["a"]["ok"] for r in rows.collect()] == [True, False, False]


def test_long_documents():
    """A million elements, deeply nested captions and licenses, are one pass."""
    at = time.time()
    flat = "<article><body>" + "<p>word</p>" * 500_000 + "</body></article>"
    assert xml.parsed(flat)["body_chars"] == 2_000_000
    assert time.time() - at < 30
