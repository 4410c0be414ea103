"""Main text of web pages by equivalence-class template deduction.

A page is read as tokens: every element opened, told apart by its path of
labelled ancestors (its role), and every block of text, told apart by its path
and a hash of the text. The pages of a host form a group, and a token's
occurrence vector says how often it stands in each of them. Tokens with equal
vectors form an equivalence class; classes that occur on most pages are valid,
and nested by their paths they make the host's template. What stands between
template tokens are slots: a block of text belongs to the slot of its nearest
template ancestor.

The vectors are never stored: a token's vector is known by the sum over pages
of a hash of (page, count), which adds up in any order, so the classes of a
host with a third of all pages come from one partial aggregation. Also summed
per token are its pages, characters of text and of links. Hosts with fewer
than ``min_pages`` pages take the template of all pages together.

The classes decide first. Text tokens of valid classes of two tokens or more
are constant text of the template, and a slot filled by it (``FIXED_SHARE``)
is a part of the template: its constant blocks are left out. A heading goes
with what stands beside it. Where next to nothing else would be left, the
pages are copies of each other and constant text tells nothing.

Second, blocks are left out whose path names something that is not the article
(navigation, header, footer, aside, form, advert, notice, comments ...);
inside the article only tags and roles are judged so, and classes of containers
that name nothing else; not words in them, nor headings and flowing text. Of the others, slots inside ``article`` or ``main`` elements are kept. A
template without any keeps slots that are not mostly links, if they have a fair
share of the text of its largest (``TEXT_SHARE``) or stand in one container
with one that has. Kept blocks are joined in page order.

Templates go back to the pages by a join on the host, broadcast only if their
bytes are counted to be few; else it is shuffled and skewed hosts can be split.

Defined cases: null or empty html gives an empty text; a null URL or one
without a host counts as the host ""; blocks outside any template slot, and
all of a page without a block in a kept slot, are judged by their own path; repeated rows are extracted each for itself and
count as so many pages; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlytics.llm.frames import only, written
from eventlytics.llm.page_parser import read_page
from eventlytics.llm.url_filter import host_and_path

ALL_HOSTS = "*"
MIN_PAGES = 3
SUPPORT = 0.5        # share of a host's pages that a valid class occurs on
LINK_SHARE = 0.5     # a slot of which more is links is a menu
TEXT_SHARE = 0.1     # of the text of the largest slot, without an article
FIXED_SHARE = 0.9    # a slot of which more is constant text is template
CLASS_TOKENS = 2     # a class of fewer tokens makes no text constant
MOST_BROADCAST = 32 << 20  # bytes of all hosts' verdicts
KEPT, OPEN, LEFT_OUT = 1, 0, -1  # verdicts on slots
# Words that mark a part of a page which is not its article (fixed values).
_NOT_TAGS = frozenset("head nav header footer aside form button select menu dialog fieldset".split())
_NOT_WORDS = re.compile(
    r"(?:^|[-_.#@0])(?:ad|ads|advert\w*|banner\w*|sponsor\w*|promo\w*|nav\w*|menu\w*|sidebar\w*|side|footer\w*|"
    r"header\w*|masthead|breadcrumb\w*|cookie\w*|consent|notice\w*|gdpr|popup\w*|modal\w*|newsletter\w*|"
    r"subscri\w*|signup|login|search\w*|comment\w*|repl(?:y|ies)|disqus|respond|share|sharing|social\w*|"
    r"related\w*|recommend\w*|pagination|pager|toolbar|contentinfo|complementary|navigation)(?=$|[-_.#@0])")
# Inside the article a class of a container (``_BOXES``) is judged as a whole:
# all its parts are such words or words of layout (fixed values).
_BOXES = frozenset("div section ul ol dl table figure center".split())
_WHOLE_WORDS = frozenset(
    ("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar breadcrumb "
     "breadcrumbs cookie cookies notice notices gdpr popup modal newsletter subscribe signup comment comments replies "
     "disqus respond share sharing social related recommended recommendations pagination pager toolbar nav navbar "
     "menu").split())
_LAYOUT_WORDS = frozenset(
    ("area bar block box buttons card cards consent container content form grid group holder inline inner item items "
     "label link links list outer panel posts row section slot stories story thread top bottom unit widget wrap "
     "wrapper articles left right main").split())
_COMMENT_IDS = frozenset("comments respond disqus_thread".split())
_FRAME = frozenset("html body main".split())
_FLOW = frozenset(("p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure figcaption table caption thead "
                   "tbody tfoot tr td th hr").split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_ABOUT_PAGE = re.compile(r"(?:no|not|has|with|without|is)[-_]")
_ARTICLE = re.compile(r"(?:^|/)article(?:[.#@/]|$)")
_MAIN = re.compile(r"(?:^|/)(?:article|main)(?:[.#@/]|$)|@main(?:[./]|$)")


def _inside(path: str, frame: str | None) -> bool:
    """True if the path has an ``article`` (or, for ``main``, a main part)."""
    return frame is not None and bool((_ARTICLE if frame == "article" else _MAIN).search(path))


def _names_noise(word: str) -> bool:
    """True if a whole class or id names what is not the article."""
    parts = [p for p in re.split(r"[-_0]+", word) if p]
    return any(p in _WHOLE_WORDS for p in parts) and all(p in _WHOLE_WORDS or p in _LAYOUT_WORDS for p in parts)


def is_noise(path: str, frame: str | None = None) -> bool:
    """True if some element of the path is no part of an article. What the
    classes of the page's own frame (``html``, ``body``, ``main``) say, and
    words like ``has-sidebar``, is about the whole page. Ids of headings are
    made from their text and say nothing; inside ``frame`` (``article`` or
    ``main``) only tags and roles are, the classes of an ``article``, and whole
    classes of containers. A heading in the article's own header is part of it."""
    within, heading = "", _tag(path) in _HEADINGS
    for label in path.split("/"):
        rest, _, role = label.partition("@")
        rest, _, ids = rest.partition("#")
        tag, *words = rest.split(".")
        inside = _inside(within, frame)
        if tag in _NOT_TAGS and not (tag == "header" and heading and inside):
            return True
        if inside and tag != "article":
            named = [*words, *(ids.split(".") if tag not in ("section", "table", "figure") else ())]
            if tag in _BOXES and (any(map(_names_noise, named)) or ids in _COMMENT_IDS):
                return True
            words = []
        elif not inside and tag not in _HEADINGS:
            words += ids.split(".")
        words += role.split(".")
        if tag not in _FRAME and any(w and not _ABOUT_PAGE.match(w) and _NOT_WORDS.search(w) for w in words):
            return True
        within = f"{within}/{label}"
    return False


def is_main(path: str) -> bool:
    return bool(_MAIN.search(path))


def frame_of(paths: Iterable[str]) -> str | None:
    """What holds the article: ``article``, else ``main``, if there is one."""
    paths = [p for p in paths if is_main(p)]
    return next((f for f in ("article", "main") if any(_inside(p, f) and not is_noise(p, f) for p in paths)), None)


def _text_key(path: str, text: str) -> int:
    digest = hashlib.blake2b(f"{path}\0{text}".encode("utf-8", "replace"), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True)


_TOKEN_FIELDS = {"page": pa.int64(), "host": pa.string(), "token": pa.string(), "text": pa.int64(),
                 "n": pa.int64(), "chars": pa.int64(), "linked": pa.int64()}


def _token_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, token, occurrences in the page, text, link text) by page; a text
    token has its path as token, and the hash ``text``."""
    for batch in batches:
        cols: list[list] = [[] for _ in _TOKEN_FIELDS]

        def out():
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols, _TOKEN_FIELDS.values())],
                                              names=list(_TOKEN_FIELDS))
        for page, host, text in zip(*(c.to_pylist() for c in batch.columns)):
            opened, blocks = read_page(text or "")
            chars, linked, same = Counter(), Counter(), Counter()
            for path, block, links in blocks:
                chars[path] += len(block)
                linked[path] += min(links, len(block))
                same[path, block] += 1
            rows = [(token, None, n, chars[token], linked[token]) for token, n in Counter(opened).items()]
            rows += [(path, _text_key(path, block), n, n * len(block), 0) for (path, block), n in same.items()]
            for row in rows:
                for col, v in zip(cols, (page, host, *row)):
                    col.append(v)
            if len(cols[0]) > 20_000:
                yield out()
                cols = [[] for _ in _TOKEN_FIELDS]
        yield out()


def deduce_templates(pages: DataFrame, min_pages: int = MIN_PAGES, support: float = SUPPORT) -> DataFrame:
    """One row per host and for ``*`` (all pages): n_pages, the template, an
    array of struct(token, class, chars, linked), and its texts, an array of
    struct(token, text, class, chars). ``class`` is equal for tokens of one
    equivalence class. ``pages``: page_id, url, html."""
    d = only(pages, "page_id", "url", "html").where("html IS NOT NULL AND html != ''")
    d = d.select(F.xxhash64("page_id", "html").alias("page"), host_and_path(F.col("url"))[0].alias("host"), "html")
    rows = d.mapInArrow(_token_rows, "page bigint, host string, token string, text bigint, n bigint, chars bigint, "
                                     "linked bigint")
    # per page and host, and once more for all hosts together
    rows = rows.withColumn("host", F.explode(F.array("host", F.lit(ALL_HOSTS))))
    big = lambda c: F.sum(c.cast("decimal(20,0)"))  # noqa: E731  hashes: no overflow
    sums = rows.groupBy("host", "token", "text").agg(
        big(F.xxhash64("page", "n")).alias("vector"), F.count(F.lit(1)).alias("on_pages"),
        F.sum("n").alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    hosts = d.select("host", "page").withColumn("host", F.explode(F.array("host", F.lit(ALL_HOSTS))))
    hosts = hosts.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"))
    valid = sums.join(hosts, "host").where(F.col("on_pages") >= support * F.col("n_pages"))
    valid = valid.where((F.col("host") == ALL_HOSTS) | (F.col("n_pages") >= min_pages))
    valid = valid.where(F.col("text").isNull() | (F.col("n_pages") >= min_pages))
    valid = valid.withColumn("class", F.xxhash64("vector", "on_pages", "n"))
    listed = lambda where, *f: F.array_sort(F.collect_list(F.when(where, F.struct(*f))))
    # a host's valid tokens are at most 1 / support times those of a page
    return valid.groupBy("host").agg(
        F.first("n_pages").alias("n_pages"),
        listed(F.col("text").isNull(), "token", "class", "chars", "linked").alias("template"),
        listed(F.col("text").isNotNull(), "token", "text", "class", "chars").alias("texts"))


def _tag(path: str) -> str:
    return re.split(r"[.#@]", path.rpartition("/")[2], maxsplit=1)[0]


def _home(path: str) -> str:
    """The container that a slot of flowing text stands in."""
    while path and _tag(path) in _FLOW:
        path = path.rpartition("/")[0]
    return path


def _below(path: str, home: str) -> bool:
    """True if ``path`` stands in ``home``; in the whole page: directly."""
    if home in ("", "html", "html/body", "body") or _tag(home) == "body":
        return _home(path) == home
    return path == home or path.startswith(home + "/")


def _constant_slots(chars: dict[str, int], fixed: Counter) -> set[str]:
    """The slots filled by constant text; none if next to nothing else is left."""
    constant = {t for t, c in chars.items() if fixed[t] >= FIXED_SHARE * c}
    for t in [t for t in constant if _tag(t) in _HEADINGS]:
        beside = [x for x in chars if x.startswith(t.rpartition("/")[0] + "/") and _tag(x) not in _HEADINGS]
        if not beside or any(x not in constant for x in beside):
            constant.discard(t)
    varying = sum(c for t, c in chars.items() if t not in constant and _tag(t) not in _HEADINGS)
    return constant if varying >= TEXT_SHARE * max((chars[t] for t in constant), default=0) else set()


def kept_slots(template, texts=()) -> tuple[dict[str, int], frozenset]:
    """(verdict on each token's slot, text keys of the constant blocks to
    leave out) of a template given as (token, class, chars, linked) and
    (token, text, class, chars) tuples."""
    size = Counter(c for _, c, _, _ in template) + Counter(c for _, _, c, _ in texts)
    fixed: Counter = Counter()
    for t, _, c, n in texts:
        fixed[t] += n if size[c] >= CLASS_TOKENS else 0
    frame = frame_of(t for t, *_ in template)
    slots = {t: (c, k) for t, _, c, k in template if c and not is_noise(t, frame)}
    article = {t: c for t, (c, _) in slots.items() if frame is None or is_main(t)}
    constant = _constant_slots(article, fixed)
    verdicts = {t: OPEN for t, *_ in template}
    if frame:
        verdicts.update({t: KEPT for t in article})
    else:
        flowing = {t: c for t, (c, k) in slots.items() if t not in constant and k <= LINK_SHARE * c}
        most = max(flowing.values(), default=0)
        homes = {_home(t) for t, c in flowing.items() if c >= TEXT_SHARE * most}
        for t in slots:
            verdicts[t] = KEPT if t in flowing and any(_below(t, h) for h in homes) else LEFT_OUT
        # nested: an element without text of its own goes with all that stands in it
        inner: dict[str, set] = {}
        for t in slots:
            up = t.rpartition("/")[0]
            while up:
                inner.setdefault(up, set()).add(verdicts[t])
                up = up.rpartition("/")[0]
        verdicts.update({t: LEFT_OUT for t, *_ in template if t not in slots and inner.get(t) == {LEFT_OUT}})
    return verdicts, frozenset(k for t, k, c, _ in texts if t in constant and size[c] >= CLASS_TOKENS)


def main_blocks(page: str, slots: dict[str, int], constant: frozenset) -> list[str]:
    """The blocks of a page that belong to its article."""
    _, blocks = read_page(page)
    frame = frame_of(p for p, _, _ in blocks)
    blocks = [(path, text, links) for path, text, links in blocks
              if not is_noise(path, frame) and (frame is None or is_main(path))]
    chars, linked = Counter(), Counter()
    for path, text, links in blocks:
        chars[path] += len(text)
        linked[path] += min(links, len(text))
    if constant:
        blocks = [x for x in blocks if _text_key(x[0], x[1]) not in constant]
    if frame is None:
        verdicts = {}
        for path in chars:
            slot = path
            while slot and slot not in slots:
                slot = slot.rpartition("/")[0]
            verdicts[path] = slots.get(slot, OPEN)
        own = KEPT not in verdicts.values()  # a page of its own layout
        blocks = [x for x in blocks if verdicts[x[0]] == KEPT or (
            (own or verdicts[x[0]] == OPEN) and linked[x[0]] <= LINK_SHARE * chars[x[0]])]
    return [text for _, text, _ in blocks]


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols: tuple[list, ...] = ([], [], [])
        for template, texts in zip(*(c.to_pylist() for c in batch.columns[1:])):
            slots, constant = kept_slots([tuple(t.values()) for t in template], [tuple(t.values()) for t in texts])
            for col, v in zip(cols, (list(slots), list(slots.values()), sorted(constant))):
                col.append(v)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *(pa.array(c, pa.list_(t)) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64())))],
            names=["host", "t_token", "t_verdict", "t_constant"])


def _extractor(default: tuple[list, list, list]):
    """``default`` is the verdict of the template of all pages."""
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, *own in zip(*(c.to_pylist() for c in batch.columns[2:])):
                tokens, verdicts, constant = default if own[0] is None else own
                texts.append("\n\n".join(main_blocks(page or "", dict(zip(tokens, verdicts)), frozenset(constant))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return extract


def extract_main_text(pages: DataFrame, min_pages: int = MIN_PAGES, support: float = SUPPORT) -> DataFrame:
    """One row per page: page_id, url and text."""
    p = only(pages, "page_id", "url", "html")
    templates = written(deduce_templates(p, min_pages, support), "templates")
    fields = ("t_token", "t_verdict", "t_constant")

    def judged(of: Column) -> DataFrame:
        return templates.where(of).select("host", "template", "texts").mapInArrow(
            _judge, "host string, t_token array<string>, t_verdict array<bigint>, t_constant array<bigint>")

    whole = judged(F.col("host") == ALL_HOSTS).head()  # one row
    default = tuple([] if whole is None else whole[f] for f in fields)
    own = written(judged(F.col("host") != ALL_HOSTS), "verdicts")
    size = own.agg(F.sum(F.octet_length(F.array_join("t_token", "")) + 24 * F.size("t_token")
                         + 8 * F.size("t_constant"))).head()[0] or 0
    d = p.withColumn("host", host_and_path(F.col("url"))[0]).join(
        F.broadcast(own) if size <= MOST_BROADCAST else own, "host", "left")
    kind = p.schema["page_id"].dataType.simpleString()
    return d.select("page_id", "url", "html", *fields).mapInArrow(
        _extractor(default), f"page_id {kind}, url string, text string")
