"""Main text of web pages by tree scoring: paragraphs pass points to their ancestors; the best container is kept."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerline.llm.common import arrow_map, schema_with

#: Elements that are never text of the article, names of parts that aren't, words that may stand beside such
#: a name, names of parts that readers write, roles of parts, and how elements flow.
DROPPED = frozenset("script style noscript template head title nav footer header aside button select textarea input iframe svg canvas object dialog menu".split())
JUNK_NAMES = frozenset("ad ads advert advertisement adverts banner sponsor sponsored promo sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header masthead notice notices cookie cookies consent alert popup modal overlay share sharing social related recommended newsletter subscribe signup login search widget pagination".split())
READER_NAMES = frozenset("comment comments disqus replies".split())
BESIDE = frozenset("area articles bar block box button buttons column container form group holder icons inner item items left link links list outer news panel post posts reader readers right section site slot stories teaser teasers thread threads top bottom unit user users wrap wrapper".split())
JUNK_ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
ARTICLES = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
PARAGRAPHS = frozenset("p pre blockquote li dd dt td th h1 h2 h3 h4 h5 h6 figcaption caption".split())
CLOSES_P = frozenset("address article aside blockquote center details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLING_CLOSES = {"li": ("li",), "dd": ("dd", "dt"), "dt": ("dd", "dt"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

#: A part with a junk name stays if it holds so much of the page's points, and so many paragraphs of so many characters.
MOST_POINTS, LONG_PARAGRAPHS, LONG = 0.95, 3, 80

_SPACE = re.compile(r"[\x20\x09-\x0D]+")
_NAME = re.compile(r"[a-z]+|[0-9]+")
_ENDS = ".!?…。:;"


def _named(value: str) -> str:
    """What a class or id says of its element: `readers`, `junk` or nothing.

    A name counts if one of its words is such a name and every other word is one too, a number, or one that says nothing of
    what it holds: `ad-box` and `comment-list` do, `with-sidebar` and `share-price` don't.
    """
    out = ""
    for name in value.lower().split():
        words = _NAME.findall(name)
        if words and all(w in JUNK_NAMES or w in READER_NAMES or w in BESIDE or w.isdigit() for w in words):
            if not READER_NAMES.isdisjoint(words):
                return "readers"
            if not JUNK_NAMES.isdisjoint(words):
                out = "junk"
    return out


def _is_cut(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Elements that are cut whatever they score: by tag, by role or because they are hidden."""
    if tag in DROPPED:
        return True
    for name, value in attrs:
        value = (value or "").lower()
        if name == "role" and value in JUNK_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


#: Elements whose contents hold no tags, of which those of the second kind have character references.
RAW, PLAIN = ("script", "style", "xmp", "iframe", "noembed", "noframes"), ("textarea", "title")
_TAG_NAME = re.compile(r"[A-Za-z][^\x20\x09-\x0D/>]*")
_ATTRIBUTE = re.compile(r"""[\x20\x09-\x0D/]*(?:([^\x20\x09-\x0D/>=][^\x20\x09-\x0D/>=]*|=[^\x20\x09-\x0D/>=]*)(?:[\x20\x09-\x0D]*=[\x20\x09-\x0D]*(?:"([^"]*)"|'([^']*)'|(?!["'])([^\x20\x09-\x0D>]*)))?)?""")
_COMMENT_END = re.compile(r"--!?>")
_RAW_END = {t: re.compile(rf"</{t}(?=[\x20\x09-\x0D/>])", re.IGNORECASE) for t in (*RAW, *PLAIN)}


class _Tree:
    """Elements in page order as parallel lists; `flow` has (element, text) with a blank where a block begins or ends.

    Any text is a page: what is no tag is text, and a tag, comment or raw element that isn't closed goes on to the end. No
    place is looked at twice, and closing looks up where the last open element of a tag stands, so the work is linear
    however elements nest.
    """

    def __init__(self) -> None:
        self.tag, self.parent, self.cut, self.names, self.flow = ["#root"], [-1], [False], [""], []
        self.open = [0]
        self.at: dict[str, list[int]] = {}

    def feed(self, html: str) -> None:
        at, n = 0, len(html)
        while at < n:
            lt = html.find("<", at)
            if lt < 0:
                self.handle_data(unescape(html[at:]))
                return
            if lt > at:
                self.handle_data(unescape(html[at:lt]))
            at = self._markup(html, lt)

    def _markup(self, html: str, lt: int) -> int:
        """Handles what begins with the `<` at a place, and returns the place after it."""
        n = len(html)
        if html.startswith("<!--", lt):
            if html.startswith(("<!-->", "<!--->"), lt):
                return html.index(">", lt) + 1
            end = _COMMENT_END.search(html, lt + 4)
            return end.end() if end else n
        if html.startswith(("<!", "<?"), lt) or html.startswith("</", lt) and lt + 2 < n and not _TAG_NAME.match(html, lt + 2):
            end = html.find(">", lt + 2)
            return end + 1 if end >= 0 else n
        closing = html.startswith("</", lt)
        name = _TAG_NAME.match(html, lt + 1 + closing)
        if not name:
            self.handle_data("<")
            return lt + 1
        tag, at, attrs = name.group().lower(), name.end(), []
        while at < n and html[at] != ">":
            m = _ATTRIBUTE.match(html, at)
            if m.group(1):
                value = m.group(2) or m.group(3) or m.group(4)
                attrs.append((m.group(1).lower(), unescape(value) if value else value))
            at = max(m.end(), at + 1)
        if at >= n:
            return n
        at += 1
        if closing:
            self.handle_endtag(tag)
            return at
        self.handle_starttag(tag, attrs)
        if tag in _RAW_END:
            end = _RAW_END[tag].search(html, at)
            stop = end.start() if end else n
            self.handle_data(unescape(html[at:stop]) if tag in PLAIN else html[at:stop])
            return stop
        return at

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in CLOSES_P:
            self._close("p", stop=("table", "td", "th", "div", "article", "section", "body", "button"))
        for other in SIBLING_CLOSES.get(tag, ()):
            self._close(other, stop=("ul", "ol", "dl", "table", "select"))
        above = self.open[-1]
        self.tag.append(tag)
        self.parent.append(above)
        self.cut.append(self.cut[above] or _is_cut(tag, attrs))
        said = "" if tag in ("body", "html", *ARTICLES) else "form" if tag == "form" else _named(" ".join(v or "" for k, v in attrs if k in ("class", "id")))
        self.names.append(said)
        if tag not in INLINE:
            self.flow.append((len(self.tag) - 1, " "))
        if tag not in VOID:
            self.at.setdefault(tag, []).append(len(self.open))
            self.open.append(len(self.tag) - 1)

    def handle_endtag(self, tag: str) -> None:
        self._close(tag)
        if tag not in INLINE:
            self.flow.append((self.open[-1], " "))

    def handle_data(self, data: str) -> None:
        if not self.cut[self.open[-1]]:
            self.flow.append((self.open[-1], data))

    def _close(self, tag: str, stop: tuple[str, ...] = ()) -> None:
        places = self.at.get(tag)
        if not places or any(self.at[s][-1] > places[-1] for s in stop if self.at.get(s)):
            return
        depth = places[-1]
        while len(self.open) > depth:
            self.at[self.tag[self.open.pop()]].pop()


def _squeezed(parts: list[str]) -> str:
    return _SPACE.sub(" ", "".join(parts)).strip(" ")


def main_text(html: str | None) -> str:
    """The text of the best container and its accepted siblings: blocks in page order, joined by one blank.

    Each block passes 1 point, 1 for each comma and 1 for each 100 characters up to 3 to its container, half to the
    container above and a sixth to the next; a block and a container count less by their share of link text. A part with a
    junk name is cut unless it holds all articles of the page or, where there is none, nearly all its points in long
    paragraphs, as is a form; one that readers wrote always is. The best container gives way to the outermost article around
    it, else to the outermost main. Siblings of the best stay if they score a fifth of it, if they end a sentence and hold
    few links, or if they hold few links and lie between others that stay; so does a heading right before what stays. Beside
    an article stay further articles with few links, and what scores as high. Null is empty, and no text is refused.
    """
    if not html:
        return ""
    tree = _Tree()
    tree.feed(html)
    n, tag, parent = len(tree.tag), tree.tag, tree.parent
    block, linked = list(range(n)), [False] * n
    for i in range(1, n):
        p = parent[i]
        block[i] = block[p] if tag[i] in INLINE else i
        linked[i] = linked[p] or tag[i] == "a"
    own, own_links, commas = [0] * n, [0] * n, [0] * n
    last: dict[int, str] = {}
    for i, text in tree.flow:
        if length := len(text.strip()):
            b = block[i]
            own[b] += length
            own_links[b] += length * linked[i]
            commas[b] += text.count(",") + text.count("、") + text.count("،")
            last[b] = text
    worth = [(1 + commas[b] + min(own[b] / 100, 3)) * (1 - own_links[b] / own[b]) if own[b] else 0.0 for b in range(n)]
    kind = "article" if any(t == "article" and not c for t, c in zip(tag, tree.cut)) else "main"
    held = [int(tag[i] == kind and not tree.cut[i]) for i in range(n)]
    total, long = list(worth), [int(own[b] >= LONG and tag[b] in PARAGRAPHS and own_links[b] < own[b] / 4) for b in range(n)]
    for i in range(n - 1, 0, -1):
        held[parent[i]] += held[i]
        total[parent[i]] += total[i]
        long[parent[i]] += long[i]
    gone = [False] * n
    for i in range(1, n):
        whole = held[i] == held[0] if held[0] else total[i] >= MOST_POINTS * total[0] and long[i] >= LONG_PARAGRAPHS
        # A form around the page holds paragraphs; one to fill in holds none.
        whole = whole or tree.names[i] == "form" and total[i] >= MOST_POINTS * total[0] and long[i] > 0
        gone[i] = gone[parent[i]] or tree.cut[i] or tree.names[i] == "readers" or tree.names[i] in ("junk", "form") and not whole
    points, ends = [0.0] * n, [False] * n
    size, links = [0] * n, [0] * n
    for b in range(n):
        if own[b] and not gone[b]:
            size[b], links[b] = own[b], own_links[b]
            at = parent[b] if tag[b] in PARAGRAPHS else b
            for part in (1, 2, 6):
                if at < 0:
                    break
                points[at] += worth[b] / part
                at = parent[at]
            ends[b] = last[b].rstrip()[-1:] in _ENDS and own_links[b] < 0.25 * own[b]
    for i in range(n - 1, 0, -1):
        size[parent[i]] += size[i]
        links[parent[i]] += links[i]
        ends[parent[i]] |= ends[i]
    score = [p * (1 - links[i] / size[i]) if size[i] else 0.0 for i, p in enumerate(points)]
    best = max(range(n), key=lambda i: (score[i], -i))
    above, at = {}, best
    while at > 0:
        above[tag[at]] = at
        at = parent[at]
    best = above.get("article", above.get("main", best))
    chosen, follows = [False] * n, False
    beside = [i for i in range(1, n) if parent[i] == parent[best] and size[i] and (i == best or not gone[i])]
    for i in reversed(beside):
        if i != best:
            calm = links[i] < 0.25 * size[i]
            scores = score[i] >= 0.2 * score[best] > 0 and (tag[best] not in ARTICLES or tag[i] in (*ARTICLES, "section"))
            says = calm and (ends[i] and (tag[i] in PARAGRAPHS or tag[i] in ("section", "div")) if tag[best] not in ARTICLES else tag[i] == tag[best])
            chosen[i] = scores or says or tag[i] in HEADINGS and follows and tag[best] not in ARTICLES
        follows = chosen[i] or i == best
    kept = [k for k, i in enumerate(beside) if chosen[i] or i == best]
    for i in beside[kept[0] : kept[-1]] if kept and tag[best] not in ARTICLES else ():  # what lies between parts that stay
        chosen[i] = chosen[i] or links[i] < 0.25 * size[i]
    chosen[best] = True
    for i in range(1, n):
        chosen[i] = (chosen[i] or chosen[parent[i]]) and not gone[i]
    return _squeezed([text for i, text in tree.flow if chosen[i] or text == " "])


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds text and n_chars (code points) to every page and drops the html column; replaces columns of those names.

    A null or empty page, and one that holds only menus and the like, has an empty text. Pages are parsed one by one, so
    memory follows the longest page, and repeated rows agree.
    """
    base = pages.drop("text", "n_chars")
    rest = [c for c in base.columns if c != html]
    base = base.select(*rest, html)
    schema = schema_with(base.select(*rest), text="string", n_chars="long")

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py()) for x in batch.column(len(rest))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*rest, "text", "n_chars"])

    return arrow_map(base, extracted, schema)
