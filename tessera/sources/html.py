"""HTML pages as a node table: one row per element, text or comment.

Only the tokeniser is Python (an event parser in ``mapInArrow``); selectors are joins and filters on
``pre``/``last`` intervals: a node's subtree is the rows of its page with pre <= x <= last.  The first row of a page has its whole
``markup`` and its ``words`` (trimmed texts joined by one blank); every row has the bytes of them that its subtree takes, so that
markup and text of a subtree are slices, with no pass over its nodes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalars import SPACES

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SCHEMA = (
    "item_id bigint, pre int, last int, parent int, depth int, ord int, kind string, tag string, text string, "
    "id string, classes array<string>, style string, href string, attrs map<string,string>, error string, "
    # bytes: [start, stop) with the own tags, behind the opening one, where the parent's content ends; of the words; texts and media below
    "start int, opened int, stop int, rest int, word int, word_end int, held int, markup string, words string"
)
_ARROW = pa.schema(
    [("item_id", pa.int64()), *((name, pa.int32()) for name in ("pre", "last", "parent", "depth", "ord")), *((name, pa.string()) for name in ("kind", "tag", "text", "id")),
     ("classes", pa.list_(pa.string())), ("style", pa.string()), ("href", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())), ("error", pa.string()),
     *((name, pa.int32()) for name in ("start", "opened", "stop", "rest", "word", "word_end", "held")), ("markup", pa.string()), ("words", pa.string())]
)
_MEDIA = frozenset(("img", "video", "audio", "table", "iframe"))
#: rows of a record batch, about: a page is never cut
_ROWS = 5_000
#: pages that are taken out of an incoming batch at once
_PAGES = 16
#: most tags: those without attributes, and those that close
_PLAIN = re.compile(r"<([a-zA-Z][^\t\n\r\f />\x00]*)>")
_END = re.compile(r"</([a-zA-Z][-.a-zA-Z0-9:_]*)>")


class _Events(HTMLParser):
    """Rows in document order.  An end tag closes its nearest open match; one without is ignored."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows: list[list] = []
        self.open: list[int] = []
        self.children: list[int] = [0]
        self.tokens: list[str] = []
        self.pieces: list[str] = []
        # bytes of the tokens, of the pieces and blanks before the next one; texts and media up to here
        self.at = self.word = self.worth = 0

    def parse_starttag(self, i):
        """A tag without attributes is read at once, any other one as the parser does."""
        found = _PLAIN.match(self.rawdata, i)
        if found is None:
            return super().parse_starttag(i)
        self.lasttag = tag = found[1].lower()
        self.handle_starttag(tag, ())
        if tag in self.CDATA_CONTENT_ELEMENTS:
            self.set_cdata_mode(tag)
        return found.end()

    def parse_endtag(self, i):
        found = _END.match(self.rawdata, i) if self.cdata_elem is None else None
        if found is None:
            return super().parse_endtag(i)
        self.handle_endtag(found[1].lower())
        return found.end()

    def updatepos(self, i, j):
        """Nobody asks for lines and columns."""
        return j

    def _token(self, text: str) -> None:
        self.tokens.append(text)
        self.at += len(text) if text.isascii() else len(text.encode())

    def _row(self, kind: str, tag: str | None, text: str | None, attrs: list | tuple, token: str) -> int:
        named: dict[str, str] = {}
        for k, v in attrs:
            named.setdefault(k, v if v is not None else "")
        if kind == "element":
            shown = "".join([f' {k}="{v.replace("&", "&amp;").replace(chr(34), "&quot;")}"' for k, v in named.items()]) if named else ""
            token = f"<{tag}{shown}/>" if tag in VOID else f"<{tag}{shown}>"
        rows, children = self.rows, self.children
        pre = len(rows)
        start, word = self.at, self.word
        self.tokens.append(token)
        self.at = at = start + (len(token) if token.isascii() else len(token.encode()))
        if kind == "text":
            piece = text.strip(SPACES)
            if piece:
                self.pieces.append(piece)
                self.word += 1 + (len(piece) if piece.isascii() else len(piece.encode()))
                self.worth += 1
        elif tag in _MEDIA:
            self.worth += 1
        parent = self.open[-1] if self.open else None
        get = named.get
        rows.append([pre, pre, parent, len(self.open), children[-1], kind, tag, text, get("id"), get("class", "").split() if named else [], get("style"), get("href"), list(named.items()), None, start, at, at, None, word, max(word, self.word - 1), self.worth, None, None])
        if kind == "element":
            children[-1] += 1
        return pre

    def handle_starttag(self, tag, attrs):
        pre = self._row("element", tag, None, attrs, "")
        if tag not in VOID:
            self.open.append(pre)
            self.children.append(0)
        else:
            self._ended(pre)

    def handle_startendtag(self, tag, attrs):
        self._ended(self._row("element", tag, None, attrs, ""))

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.rows[self.open[at]][6] == tag:
                self._close(at)
                return

    def handle_data(self, data):
        self._ended(self._row("text", None, data, (), data.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")))

    def handle_comment(self, data):
        self._ended(self._row("comment", None, data, (), f"<!--{data}-->"))

    def _ended(self, pre: int) -> None:
        """The bytes and counts of a node that ends here; ``rest`` has where its own content ends until all are known."""
        row = self.rows[pre]
        row[1] = len(self.rows) - 1
        row[17] = self.at
        if row[5] == "element" and row[6] not in VOID:
            self._token(f"</{row[6]}>")
        row[16] = self.at
        row[19] = max(row[18], self.word - 1)
        row[20] = self.worth - row[20]

    def _close(self, at: int) -> None:
        for pre in reversed(self.open[at:]):
            self._ended(pre)
        del self.open[at:], self.children[at + 1 :]

    def finish(self) -> list[list]:
        self.close()
        self._close(0)
        ends = [r[17] for r in self.rows]
        for row in self.rows:
            row[17] = None if row[2] is None else ends[row[2]]
        if self.rows:
            self.rows[0][21:] = "".join(self.tokens), " ".join(self.pieces)
        return self.rows


def shred(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", columns: tuple[str, ...] | None = None) -> DataFrame:
    """The node table of ``pages``, or those of its ``columns`` that are wanted.  Errors are rows: a page that is null or blank, or lacks html or
    body, gives one row of kind ``error`` beside what could be read."""

    wanted = [f for f in _ARROW if columns is None or f.name in columns]
    at = [_ARROW.get_field_index(f.name) for f in wanted]

    def batch(items: list[int], rows: list[list]) -> pa.RecordBatch:
        columns = [items, *zip(*rows, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(columns[i], f.type) for i, f in zip(at, wanted, strict=True)], schema=pa.schema(wanted))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: list[int] = []
        out: list[list] = []
        for part in (whole.slice(at, _PAGES) for whole in parts for at in range(0, whole.num_rows, _PAGES)):
            for item, html in zip(part.column("item_id").to_pylist(), part.column("html").to_pylist(), strict=True):
                rows = []
                if html and html.strip():
                    events = _Events()
                    events.feed(html)
                    rows = events.finish()
                tags = {r[6] for r in rows}
                missing = "empty page" if not rows else ", ".join(f"no {t}" for t in ("html", "body") if t not in tags)
                out += rows
                if missing:
                    out.append([-1, -1, None, 0, 0, "error", None, None, None, [], None, None, [], missing, *[None] * 9])
                items += [item] * (len(out) - len(items))
                if len(out) >= _ROWS:
                    yield batch(items, out)
                    items, out = [], []
        if out:
            yield batch(items, out)

    kept = ", ".join(c for c in SCHEMA.split(", ") if columns is None or c.split()[0] in columns)
    return pages.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(html_col).alias("html")).mapInArrow(run, kept)
