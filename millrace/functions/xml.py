"""Article XML: one parse for each document, everything else in expressions."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections import Counter
from functools import partial
from xml.parsers import expat

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

#: The attribute and the elements that refer to media.
XLINK = "{http://www.w3.org/1999/xlink}href"
MEDIA = ("graphic", "inline-graphic", "media", "supplementary-material")
_XLINK_KEY = XLINK[1:]
#: Characters that a document with internal entities may hold once they are expanded: so many, and so many times its length.
ENTITY_CHARS, ENTITY_GROWTH = 1 << 16, 8
_KINDS = {"b": BooleanType(), "s": StringType(), "n": LongType(), "a": ArrayType(StringType())}
PARSED = StructType([StructField(n, _KINDS[k]) for k, names in (
    ("b", ["ok"]), ("s", ["error", "license_text", "doi", "title", "journal"]), ("a", ["license_urls", "captions", "hrefs"]),
    ("n", ["text_chars", "body_chars", "figures", "tables", "formulas"]),
) for n in names])


def _name(e) -> str:
    return e.tag.rpartition("}")[2] if isinstance(e.tag, str) else ""


def _all(root, *names: str) -> list:
    return [e for e in root.iter() if _name(e) in names]


def _href(e) -> str:
    return (e.get(XLINK) or e.get("href") or e.get("xlink:href") or "").strip()


def _ordered(values) -> list[str]:
    return list(dict.fromkeys(v for v in values if v))


class Budget(ValueError):
    """A document whose entities expand to more than they may."""


class Entities:
    """The lengths that a document's internal entities expand to, as they are declared, and how much has been expanded."""

    _REFERENCE = re.compile(r"&(#?[^;&\s]+);")

    def __init__(self, most: int):
        self.lengths, self.most, self.read = {}, most, 0

    def declare(self, name, parameter, value, *_):
        if value is None or parameter:  # external ones are not read
            return
        plain = self._REFERENCE.sub("", value)
        inner = sum(1 if r.startswith("#") else self.lengths.get(r, 1) for r in self._REFERENCE.findall(value))
        self.lengths.setdefault(name, len(plain) + inner)
        if self.lengths[name] > self.most:
            raise Budget(f"entity {name} expands to {self.lengths[name]} characters, more than {self.most}")

    def count(self, chars: int):
        self.read += chars
        if self.lengths and self.read > self.most:
            raise Budget(f"entities expand to more than {self.most} characters")


class Reading:
    """One pass over a document's events.

    Texts are pieces in one list; an element's text is what came between its start and its
    end. What an element of interest leaves is put in a slot when it starts, so that lists
    are in order of starts, and filled when it ends.
    """

    def __init__(self, entities: Entities):
        self.entities, self.pieces, self.open, self.root = entities, [], [], None
        self.licenses, self.captioned, self.hrefs, self.bodies, self.counts = [], [], [], [], Counter()
        self.title, self.journal, self.doi = [], [], []
        self.in_licenses, self.in_captioned = [], []

    def start(self, tag: str, attributes: dict):
        name = tag.rpartition("}")[2]
        if self.root is None:
            self.root = name
        self.entities.count(sum(map(len, attributes.values())))
        href = (attributes.get(_XLINK_KEY) or attributes.get("href") or attributes.get("xlink:href") or "").strip()
        done = []  # what takes this element's text when it ends
        self.counts[name] += 1
        if name == "license":
            self.licenses.append({"text": "", "links": [href]})
            self.in_licenses.append(self.licenses[-1])
            done.append(partial(self.licenses[-1].__setitem__, "text"))
        elif name in ("ext-link", "uri"):
            for license_ in self.in_licenses:
                license_["links"].append(href)
                if not href:
                    done.append(partial(license_["links"].__setitem__, len(license_["links"]) - 1))
        elif name in ("fig", "table-wrap"):
            self.captioned.append([])
            self.in_captioned.append(self.captioned[-1])
        elif name == "caption":
            for captions in self.in_captioned:
                if not captions:
                    captions.append("")
                    done.append(partial(captions.__setitem__, 0))
        elif name in MEDIA:
            self.hrefs.append(href)
        elif name == "body":
            done.append(self.bodies.append)
        elif name in ("article-title", "journal-title"):
            first = self.title if name == "article-title" else self.journal
            if not first:
                first.append("")
                done.append(partial(first.__setitem__, 0))
        elif name == "article-id" and not self.doi and (attributes.get("pub-id-type") or "").lower() == "doi":
            self.doi.append("")
            done.append(partial(self.doi.__setitem__, 0))
        self.open.append((name, len(self.pieces), done))

    def text(self, data: str):
        self.entities.count(len(data))
        self.pieces.append(data)

    def end(self, tag: str):
        name, at, done = self.open.pop()
        if done:
            text = _flat(self.pieces[at:])
            for take in done:
                take(text)
        if name == "license":
            self.in_licenses.pop()
        elif name in ("fig", "table-wrap"):
            self.in_captioned.pop()

    def other(self, data: str):
        """What the parser hands on as it stands: references to entities that are not declared among it."""
        if data.startswith("&"):
            raise ValueError(f"undefined entity {data}")

    def fields(self) -> dict:
        n = self.counts
        return {
            "ok": True, "error": None, "license_text": " ".join(x["text"] for x in self.licenses), "license_urls": _ordered(u for x in self.licenses for u in x["links"]),
            "captions": [c for [c] in filter(None, self.captioned) if c], "doi": "".join(self.doi), "title": "".join(self.title), "journal": "".join(self.journal),
            "text_chars": len(_flat(self.pieces)), "body_chars": sum(map(len, self.bodies)), "figures": n["fig"], "tables": n["table-wrap"],
            "formulas": n["disp-formula"] + n["inline-formula"] + n["math"], "hrefs": _ordered(self.hrefs),
        }


def _flat(pieces: list[str]) -> str:
    return " ".join("".join(pieces).split())


def read(data: bytes) -> Reading:
    """The events of a document, read once. Raises for what is not well-formed and for entities beyond their budget."""
    parser = expat.ParserCreate(namespace_separator="}")
    parser.buffer_text = True
    entities = Entities(ENTITY_CHARS + ENTITY_GROWTH * len(data))
    reading = Reading(entities)
    parser.StartElementHandler, parser.EndElementHandler = reading.start, reading.end
    parser.CharacterDataHandler, parser.EntityDeclHandler = reading.text, entities.declare
    parser.DefaultHandlerExpand = reading.other
    parser.Parse(data, True)
    return reading


def parsed(text: str | bytes | None) -> dict:
    """The fields of PARSED of one document. Internal entities are read as long as all texts
    stay within ENTITY_CHARS and ENTITY_GROWTH times the document; beyond, the document is an error."""
    try:
        reading = read((text or "").encode() if isinstance(text or "", str) else text)
    except (expat.ExpatError, ValueError, LookupError) as e:
        return {"ok": False, "error": str(e)[:300]}
    return reading.fields() if reading.root == "article" else {"ok": False, "error": f"not_article:{reading.root}"}


@F.pandas_udf(PARSED)
def _parse(texts: pd.Series) -> pd.DataFrame:
    # rows of objects, so that a field a document lacks stays None and does not become NaN
    rows = [[r.get(n) for n in PARSED.names] for r in map(parsed, texts)]
    return pd.DataFrame(rows, columns=PARSED.names, dtype=object)


#: Not deterministic to the optimizer, so a filter on its result does not run it twice.
parse_xml = _parse.asNondeterministic()


@F.pandas_udf(StringType())
def _rewrite(texts: pd.Series, members: pd.Series, bases: pd.Series) -> pd.Series:
    each = zip(texts, members, bases, strict=True)
    return pd.Series([None if t is None else rewritten(t, {e["key"]: e["value"] for e in (() if m is None else m)}, b or "").decode("utf-8") for t, m, b in each], dtype=object)


def rewrite_media(text, members, base):
    """A column of documents with the media of members (map URL -> archive member) renamed; null stays null."""
    return _rewrite(text, F.transform(F.map_entries(members), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"))), base)


def rewritten(text: str, members: dict[str, str], base: str) -> bytes:
    """The document with the media references of downloaded URLs replaced by members."""
    from urllib.parse import urljoin

    ET.register_namespace("xlink", XLINK[1:-5])
    if "<!ENTITY" in text:
        read(text.encode())  # raises beyond the budget, which this parser has not
    root = ET.fromstring(text)
    for e in _all(root, *MEDIA):
        if (href := _href(e)) and (member := members.get(urljoin(base, href))):
            # the namespaced attribute is written unless a plain one stands alone; another spelling of it goes
            e.attrib.pop("xlink:href", None)
            e.set("href" if "href" in e.attrib and XLINK not in e.attrib else XLINK, member)
    return ET.tostring(root, encoding="utf-8", xml_declaration=True)
