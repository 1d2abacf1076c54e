"""Fields of web pages, by parsing their tags."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NO_DESCRIPTION = "Description not available"
NO_TOOLS = "Tools information not available"
WATCH, EMBED = "https://www.youtube.com/watch?v=", "youtube.com/embed/"

_TEXT, _MANY = T.StringType(), T.ArrayType(T.StringType())
FIELDS = T.StructType([T.StructField(n, _TEXT) for n in ("title", "lang", "description")] + [T.StructField(n, _MANY) for n in ("headings", "items", "links", "videos", "labels")])

#: Elements whose text is a field, and which of them end when another one of the group begins.
_TEXTS = {"title": "title", "h1": "headings", "li": "items", "dt": "terms", "dd": "values"}
_GROUPS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
_LISTS = {"ul": ("li",), "ol": ("li",), "dl": ("dt", "dd")}


class _Page(HTMLParser):
    """The fields of one page. Names of tags and attributes count in either case, attributes in any order and quotes;
    character references are decoded; comments, scripts and styles hold no fields."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.lang = self.description = None
        self.found: dict[str, list[str]] = {name: [] for name in _TEXTS.values()}
        self.links, self.videos, self.frames = {}, [], []
        self.open: list[tuple[str, list[str]]] = []  # elements whose text is being gathered
        self.pairs: list[tuple[str, str]] = []
        self.term, self.framed, self.raw = None, None, False  # framed: within a video's element, whether its first frame is yet to come
        self.feed(html)
        self.close()
        while self.open:
            self._end(self.open[-1][0])

    def handle_starttag(self, tag, attributes):
        given = {name: value or "" for name, value in reversed(attributes)}  # of repeated ones the first counts
        if tag == "html":
            self.lang = self.lang or given.get("lang") or None
        elif tag == "meta" and given.get("name", "").strip().lower() == "description":
            self.description = self.description or given.get("content") or None
        elif tag == "a" and "href" in given:
            self.links.setdefault(given["href"])
        elif tag == "devsite-video":
            if given.get("video-id"):
                self.videos.append(WATCH + given["video-id"])
            self.framed = True
        elif tag == "iframe" and EMBED in given.get("src", ""):
            link = WATCH + given["src"].split("/")[-1].split("?")[0]
            if self.framed:
                self.videos.append(link)
            self.frames.append(link)
        if tag == "iframe" and self.framed:
            self.framed = False
        self.raw = tag in ("script", "style")
        if tag in _TEXTS:
            at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] in _GROUPS.get(tag, ()) or self.open[i][0] in _LISTS), None)
            if at is not None and self.open[at][0] not in _LISTS:  # an element of the group that has not been closed
                self._end(self.open[at][0])
            self.open.append((tag, []))
        elif tag in _LISTS:
            self.open.append((tag, []))

    def handle_endtag(self, tag):
        self.raw = False
        if tag == "devsite-video":
            self.framed = None
        elif tag in _LISTS or tag in _TEXTS:
            self._end(tag)

    def _end(self, tag: str) -> None:
        """Close the innermost open element of that name, and all within it."""
        if tag not in (name for name, _ in self.open):
            return
        while True:
            name, parts = self.open.pop()
            text = " ".join("".join(parts).split())
            if name in _TEXTS:
                self.found[_TEXTS[name]].append(text)
            if name == "dt":
                self.term = text
            elif name == "dd" and self.term is not None:
                self.pairs.append((self.term, text))
                self.term = None
            if name == tag:
                return

    def handle_data(self, data):
        for name, parts in self.open if not self.raw else ():
            if name in _TEXTS:
                parts.append(data)

    def fields(self) -> tuple:
        videos = list(self.videos)
        for link in self.frames:
            if link not in videos:
                videos.append(link)
        titles = self.found["title"]
        return (titles[0] if titles else "", self.lang, self.description or NO_DESCRIPTION, self.found["headings"], self.found["items"], list(self.links), videos, [f"{t}: {v}" for t, v in self.pairs])


@F.pandas_udf(FIELDS)
def _parsed(html: pd.Series) -> pd.DataFrame:
    nothing = (None,) * len(FIELDS)
    return pd.DataFrame([_Page(page).fields() if page is not None else nothing for page in html], columns=FIELDS.names)


def page_fields(html: Column) -> Column:
    """A struct of a page's title, lang, description, headings (h1), items (list items), links (targets, repeats removed),
    videos (watch URLs: of video elements by attribute and by the first frame within, then of other frames that are not
    there yet) and labels (`term: value` of definition lists). A page is parsed once, in Arrow batches. A text's
    white space is collapsed; an item that is not closed ends where the next begins; an outer item's text has that of the items
    in it. All fields of a null page are null."""
    return _parsed(html)


def list_items(fields: Column) -> Column:
    """Text of all list items, comma-separated; a fixed text where there is none."""
    return F.when(F.size(fields["items"]) > 0, F.array_join(fields["items"], ", ")).otherwise(F.lit(NO_TOOLS))
