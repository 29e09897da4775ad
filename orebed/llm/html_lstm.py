"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks. Each block is read as a vector of its tag
path (with class and id words), a vector of its hashed words and a few measures; a
bidirectional LSTM labels every block in the light of the whole page. It is trained here on
pages that are composed from the words of a bounded sample of the table, with known labels,
and on the sample itself where its markup names the article.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orebed.llm import block_lstm
from orebed.llm.common import columns_of

#: About this many pages, those with the smallest hashes of their id, are learned from.
SAMPLED, COMPOSED = 160, 480
#: Blocks of a training page, and steps times pages of one labelling batch.
LONGEST, STEPS = 64, 1 << 15
PATH, WORDS = 128, 64

#: Element names of HTML by their role.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template svg math head title iframe object select option button textarea canvas audio video map".split())
RAW = set("script style textarea title noscript iframe template".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
SCOPES = {"li": {"ul", "ol", "menu"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "tr": {"table"}, "dt": {"dl"}, "dd": {"dl"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|[^<]+|<", re.DOTALL)
_NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_SPLIT = re.compile(r"[^a-zA-Z]+|(?<=[a-z])(?=[A-Z])")
#: Marks the article of composed pages; part of no feature.
_TARGET = "data-target"


class Block:
    """A leaf block: its text, its path of elements, how much of it is links, its label."""

    __slots__ = ("linked", "path", "target", "text")

    def __init__(self, text: str, path: tuple, linked: int, target: bool):
        self.text, self.path, self.linked, self.target = text, path, linked, target


def _element(tag: str, attributes: str) -> tuple[str, ...]:
    """The element's name and the words of its class, id and role."""
    names = [tag]
    if "=" in attributes:
        for m in _NAMES.finditer(attributes):
            names += [w.lower() for w in _SPLIT.split(m[2] or m[3] or m[4] or "") if w]
    return tuple(names)


def blocks(page: str | None) -> list[Block]:
    """The leaf blocks of a whole page in order, without empty ones; none for null.

    Character references are decoded, white space runs become one space. Elements that show
    no text of the page are passed over, unclosed ones are closed as HTML has it.
    """
    out: list[Block] = []
    stack: list[tuple] = []  # (tag, element, marked as target)
    held: list[str] = []
    linked = [0]

    def flush() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append(Block(text, tuple(e for _, e, _ in stack), linked[0], any(t for _, _, t in stack)))
            held.clear()
            linked[0] = 0

    def close(depth: int) -> None:
        del stack[depth:]

    at, page = 0, page or ""
    hidden = 0
    while at < len(page):
        m = _TOKEN.match(page, at)
        if m is None:  # an unclosed quote: take the sign as text
            held.append(page[at])
            at += 1
            continue
        at = m.end()
        tag = m[2]
        if tag is None:
            piece = m[0]
            if not hidden and not (piece.startswith("<") and len(piece) > 1):
                held.append(piece)
                if any(t == "a" for t, _, _ in stack):
                    linked[0] += len(piece)
            continue
        tag = tag.lower()
        if m[1]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), -1)
            if tag in BLOCKS:
                flush()
            if depth >= 0:
                if any(t in BLOCKS for t, _, _ in stack[depth:]):
                    flush()
                close(depth)
                hidden = sum(t in HIDDEN for t, _, _ in stack)
            continue
        if tag in BLOCKS:
            flush()
            hides = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == "p"), -1)
            if hides >= 0:
                close(hides)
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in SCOPES.get(tag, ()):
                    break
                if stack[k][0] == tag and tag in SCOPES or {stack[k][0], tag} == {"dt", "dd"}:
                    close(k)
                    break
            if tag == "body":
                close(next((k for k, s in enumerate(stack) if s[0] == "head"), len(stack)))
        if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
            held.append(" " if tag in ("br", "wbr", "img", "hr") else "")
        elif tag in RAW:
            if tag in ("noscript", "template"):
                stack.append((tag, _element(tag, m[3]), False))
            else:
                end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
                at = end.end() if end else len(page)
        else:
            stack.append((tag, _element(tag, m[3]), _TARGET in m[3]))
        hidden = sum(t in HIDDEN for t, _, _ in stack)
    flush()
    return out


def _kinds() -> np.ndarray:
    """1 for marks, 2 for digits, 3 for capitals among the first 1,024 code points."""
    table = np.zeros(1024, np.int64)
    for c in map(chr, range(1024)):
        table[ord(c)] = 1 if c in ",.;:!?" else 2 if c.isdigit() else 3 if c.isupper() else 0
    return table


_KIND = _kinds()


def _place(word: str) -> int:
    """Place of a word among 2 * WORDS, the upper half of which counts as negative."""
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & (2 * WORDS - 1)


@lru_cache(maxsize=1 << 14)
def _path_vector(path: tuple) -> np.ndarray:
    out = np.zeros(PATH, np.float32)
    before = "root"
    for up, element in enumerate(reversed(path)):
        weight = max(0.3, 1 - 0.15 * up)
        for name in {*element, f"{before}<{element[0]}", f"last {element[0]}" if up == 0 else ""} - {""}:
            code = zlib.crc32(name.encode())
            out[code % PATH] += weight if code >> 31 else -weight
        before = element[0]
    return np.clip(out, -2, 2)


MEASURES = 12


def features(found: list[Block]) -> np.ndarray:
    """One row per block: path vector, hashed-word vector, measures."""
    out = np.zeros((len(found), PATH + WORDS + MEASURES), np.float32)
    for k, b in enumerate(found):
        words = b.text.lower().split()
        out[k, :PATH] = _path_vector(b.path)
        places = np.fromiter(map(_place, words), np.int64, len(words))
        signed = np.bincount(places, minlength=2 * WORDS)
        hashed = signed[:WORDS] - signed[WORDS:]
        out[k, PATH : PATH + WORDS] = hashed / max(1.0, np.sqrt(hashed @ hashed))
        n = len(b.text)
        kinds = np.bincount(_KIND[np.minimum(np.frombuffer(b.text.encode("utf-32-le", "surrogatepass"), "<u4"), 1023)], minlength=4)
        out[k, -MEASURES:] = (
            np.log1p(min(n, 1000)) / 6,  # beyond that, length says no more
            np.log1p(min(len(words), 200)) / 5,
            min(1.0, b.linked / n),
            b.path[-1][0] in ("h1", "h2", "h3") if b.path else 0,
            b.text[-1] in ".!?\"'”»",
            min(1.0, 10 * kinds[1] / n),
            kinds[2] / n,
            kinds[3] / n,
            k / len(found),
            len(found) < 4,
            "©" in b.text or "@" in b.text,
            1,
        )
    return out


# Words and class names that pages use for their parts.
CONTENT_NAMES = "article content post entry story post-content article-body entry-content main-text text body page-content".split()
PARTS = {
    "menu": "nav menu navbar navigation topnav main-menu menu-list breadcrumb breadcrumbs tabs".split(),
    "header": "header site-header masthead top topbar branding logo page-header".split(),
    "sidebar": "sidebar aside widget related side rail more-links recommended popular secondary".split(),
    "advert": "ad ads advert advertisement banner sponsor sponsored promo promotion ad-slot adbox".split(),
    "notice": "notice cookie cookies consent gdpr alert cookie-banner popup modal newsletter-popup warning message".split(),
    "form": "form search login subscribe signup newsletter contact-form search-box".split(),
    "comments": "comments comment discussion replies responses comment-list disqus reader-comments feedback".split(),
    "footer": "footer site-footer bottom copyright colophon foot legal credits".split(),
    "share": "share social sharing tags meta byline author-box pagination pager".split(),
}
TAGS = {"menu": "nav", "header": "header", "sidebar": "aside", "form": "form", "footer": "footer", "comments": "section"}
SHORT = "Home About Contact Login Search Subscribe Share Tweet Next Previous Menu Archive Tags RSS Print Reply Register Help".split()
LINES = {
    "notice": ["We use cookies.", "By using this site you accept our terms.", "Accept", "This site uses cookies to improve your experience."],
    "footer": ["&copy; 2024 All rights reserved.", "Copyright &copy; example.com", "Privacy policy &middot; Terms of use", "Powered by"],
    "comments": ["Comments", "3 comments", "Leave a reply", "Reply", "Posted by guest on 3 May", "Anonymous wrote:"],
    "form": ["Email", "Name", "Your message", "Sign up for our newsletter", "Search this site", "Send"],
    "advert": ["Advertisement", "Sponsored", "Buy now!", "Ad"],
    "sidebar": ["Related articles", "Most read", "Categories", "Recent posts", "About the author"],
    "share": ["Share this", "Tags:", "Filed under", "Posted on 4 June 2023", "by admin"],
}


def compose(rng: np.random.Generator, words: list[str]) -> str:
    """A page of random make-up from the given words; its article is marked."""

    def pick(options):
        return options[int(rng.integers(len(options)))]

    def prose(low: int, high: int) -> str:
        text = " ".join(pick(words) for _ in range(int(rng.integers(low, high))))
        text = text.strip(".,;") or "word"
        return text[0].upper() + text[1:] + pick([".", ".", ".", "!", "?", ""])

    def wrap(kind: str, inside: str) -> str:
        name = pick(PARTS[kind])
        tag = TAGS.get(kind, "div") if rng.random() < 0.55 else pick(["div", "div", "section", "aside" if kind == "sidebar" else "div"])
        named = f' {pick(["class", "class", "id"])}="{name}{pick(["", "", " box", " wrap", "-inner"])}"'
        return f"<{tag}{named if tag == 'div' or rng.random() < 0.6 else ''}>{inside}</{tag}>"

    def part(kind: str) -> str:
        if kind in ("menu", "share") or kind in ("footer", "sidebar", "header") and rng.random() < 0.4:
            items = [pick(SHORT) if rng.random() < 0.4 else pick(words) for _ in range(int(rng.integers(2, 8)))]
            if rng.random() < 0.8:
                inside = "<ul>" + "".join(f'<li><a href="/{i}">{x}</a></li>' for i, x in enumerate(items)) + "</ul>"
            else:
                inside = " | ".join(f'<a href="/{i}">{x}</a>' for i, x in enumerate(items))
            return wrap(kind, (f"<h3>{pick(LINES[kind])}</h3>" if kind in LINES and rng.random() < 0.5 else "") + inside)
        if kind == "comments":
            note = pick(PARTS["comments"][:2])
            said = "".join(
                f'<div class="{note}">' + (f"<b>{pick(words)}</b> " if rng.random() < 0.5 else "") + f"<p>{prose(3, 50)}</p></div>"
                if rng.random() < 0.7
                else f"<li>{prose(3, 40)}</li>"
                for _ in range(int(rng.integers(1, 6)))
            )
            return wrap(kind, (f"<h3>{pick(LINES[kind])}</h3>" if rng.random() < 0.6 else "") + said)
        if kind == "form":
            fields = "".join(f'<label>{pick(LINES[kind])}</label><input name="x">' for _ in range(int(rng.integers(1, 4))))
            text = f"<p>{prose(3, 20)}</p>" if rng.random() < 0.4 else ""
            return wrap(kind, f'<form action="/x">{text}{fields}<button>Send</button></form>')
        text = pick(LINES[kind]) if kind in LINES and rng.random() < 0.4 else ""
        more = [prose(3, 30) for _ in range(int(rng.integers(1, 3)))]
        inside = "".join(f"<p>{x}</p>" for x in more) if rng.random() < 0.5 else " ".join(more)
        return wrap(kind, text + (" &middot; " if text else "") + inside)

    body = []
    title = prose(3, 11).rstrip(".")
    if rng.random() < 0.85:
        body.append(f"<h1>{title}</h1>")
    for _ in range(int(rng.integers(1, 14)) if rng.random() < 0.9 else int(rng.integers(14, 50))):
        kind = rng.random()
        text = prose(1, 90) if rng.random() < 0.85 else prose(1, 4)
        if kind < 0.6:
            body.append(f"<p>{text}</p>")
        elif kind < 0.72:
            body.append(f"<p><b>{text}<br>")
        elif kind < 0.8:
            body.append(f"<p>{text} <a href='/y'>{pick(words)}</a> {prose(2, 20)}</p>")
        elif kind < 0.86:
            body.append(f"<h2>{prose(2, 8)}</h2>")
        elif kind < 0.92:
            body.append("<ul>" + "".join(f"<li>{prose(2, 20)}</li>" for _ in range(3)) + "</ul>")
        elif kind < 0.96:
            body.append(f"<blockquote><p>{text}</p></blockquote>")
        else:
            body.append(part(pick(["advert", "share", "sidebar"])).replace("<section", "<div").replace("</section", "</div"))
    marked = "".join(re.sub(r"<(p|h1|h2|li|blockquote)(?=[ >])", rf"<\1 {_TARGET}", x) if not x.startswith(("<div", "<aside")) else x for x in body)
    outer = pick(["article", "article", "main", "div", "div", "section"])
    named = f' class="{pick(CONTENT_NAMES)}"' if outer == "div" or rng.random() < 0.3 else ""
    main = f"<{outer}{named}>{marked}</{outer}>"
    if rng.random() < 0.3:
        main = f'<div id="{pick(["main", "wrapper", "page", "container"])}">{main}</div>'
    before = [part(k) for k in ("notice", "header", "menu", "menu", "advert", "share") if rng.random() < 0.45]
    after = [part(k) for k in ("share", "advert", "comments", "sidebar", "form", "footer", "notice") if rng.random() < 0.45]
    if rng.random() < 0.3:
        before.append(part("sidebar"))
    return f"<html><head><title>{title}</title></head><body>{''.join(before)}{main}{''.join(after)}</body></html>"


def named_article(found: list[Block]) -> np.ndarray | None:
    """Labels of a real page whose markup names one article; None where it does not."""
    other = {name for names in PARTS.values() for name in names} | {"nav", "aside", "footer", "form"}
    inside = np.array([any(e[0] == "article" for e in b.path) for b in found])
    parts = np.array([any(w in other for e in b.path for w in e) for b in found])
    return (inside & ~parts).astype(np.float32) if inside.any() else None


def train(pages: list[str | None], seed: int = 11) -> dict[str, np.ndarray]:
    """The labeller, from real pages and pages composed from their words."""
    rng = np.random.default_rng(seed)
    parsed = [blocks(p)[:LONGEST] for p in pages]
    words = sorted({w for found in parsed for b in found for w in b.text.split()[:40]}) or ["word"]
    sequences, labels = [], []
    for found in parsed:
        y = named_article(found) if found else None
        if y is not None:
            sequences.append(features(found))
            labels.append(y)
    for _ in range(COMPOSED):
        found = blocks(compose(rng, words))[:LONGEST]
        if found:
            sequences.append(features(found))
            labels.append(np.array([b.target for b in found], np.float32))
    return block_lstm.fit(sequences, labels, seed)


def label(model: dict, pages: list[list[Block]]) -> list[np.ndarray]:
    """For each page, which of its blocks belong to the main text."""
    out: list = [np.zeros(0, bool)] * len(pages)
    order = sorted((k for k in range(len(pages)) if pages[k]), key=lambda k: len(pages[k]))
    while order:
        group, longest = [], 0
        while order and (not group or max(longest, len(pages[order[0]])) * (len(group) + 1) <= STEPS) and len(group) < 128:
            longest = max(longest, len(pages[order[0]]))
            group.append(order.pop(0))
        x, mask = block_lstm.padded([features(pages[k]) for k in group])
        score = block_lstm.logits(model, x, mask)
        for column, k in enumerate(group):
            out[k] = score[: len(pages[k]), column] > 0
    return out


def _extract(model: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = [blocks(v.as_py()) for v in batch.column("html")]
            kept = label(model, pages)
            texts = ["\n".join(b.text for b, k in zip(page, keep, strict=True) if k) for page, keep in zip(pages, kept, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars"],
            )

    return run


def sample(pages: DataFrame) -> list[str | None]:
    """About SAMPLED pages with the smallest hashes of their id, to the driver."""
    share = min(1.0, SAMPLED / max(1, pages.count()))
    near = F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 30)) < int(share * (1 << 30))
    return [r["html"] for r in pages.where(near).orderBy("page_id", "html").collect()]


def main_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    text is the main text of the whole html, its blocks joined by line ends, and empty for
    null or empty html and where no block is labelled as main text. Rows with null or
    repeated ids stay; other columns are left out; an empty table gives an empty table.
    """
    rows = columns_of(pages, page_id="long", url="string", html="string")
    return rows.mapInArrow(_extract(train(sample(rows))), "page_id long, url string, text string, n_chars long")
