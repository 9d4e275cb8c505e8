"""Main text of HTML pages by a recurrent block labeller that is trained on the pages themselves.

Labels come from pages whose markup says what is what (``article``, ``nav``,
``footer`` and the like). From their texts further pages are made up, with
other and less telling markup and with the parts that real sites have besides: notices, side
columns, forms, comments. The labeller learns from both.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.blocklstm import BlockLabeller, Features
from tallyworks.llm.htmlblocks import Block, blocks_of
from tallyworks.llm.words import slices

# At most so many pages are collected for training, those of smallest hash, and pages made up from them.
TRAINING_PAGES, MADE_PAGES = 240, 1800
# Pages of more characters or blocks are not trained on.
TRAINING_CHARS, TRAINING_BLOCKS = 200_000, 1000
EPOCHS, RATE = 10, 0.012
SEED = 11

# Markup that says what a block is.
MAIN_TAGS = frozenset(("article", "main"))
OTHER_TAGS = frozenset(("nav", "footer", "aside", "form", "header", "dialog", "menu"))
OTHER_NAMES = frozenset(
    "ad ads advert advertisement banner promo sponsored sidebar menu nav navbar navigation breadcrumb breadcrumbs footer cookie cookies consent "
    "notice comment comments reply replies disqus discussion share social related recommended newsletter subscribe login popup modal widget hidden".split()
)

# Words of the parts that made-up pages have besides the text.
NOTICES = ["We use cookies to improve this site.", "Accept all", "By going on you agree to our terms.", "Please disable your ad blocker.", "This site uses cookies."]
FORMS = ["Subscribe to our newsletter", "Your email", "Sign in", "Search", "Send", "Leave a reply", "Name", "Log in to comment"]
SIDE = ["Related articles", "Most read", "Latest news", "Popular posts", "Tags", "Archive", "About us", "Follow us", "Share this"]
FOOT = ["All rights reserved.", "Privacy policy", "Terms of use", "Contact", "Imprint", "Powered by", "© 2021", "© Example"]
FALLBACK_TEXTS = ["A page has a text of some length. It goes on for a while, and then it ends.", "Another paragraph follows, with more to say."]


def told_label(block: Block) -> int | None:
    """1 or 0 where the path says so: the innermost telling element decides; None where nothing does."""
    for element in reversed(block.path):
        if element[0] in OTHER_TAGS and not (element[0] == "header" and any(e[0] in MAIN_TAGS for e in block.path)):
            return 0
        if OTHER_NAMES.intersection(element[1:]):
            return 0
        if element[0] in MAIN_TAGS:
            return 1
    return None


def _path(*elements: str) -> tuple[tuple[str, ...], ...]:
    return tuple(tuple(e.replace(".", " ").replace("-", " ").split()) for e in ("html", "body", *elements))


def made_page(rng: np.random.Generator, texts: list[str]) -> list[Block]:
    """A page of random layout with labels."""

    def one(options):
        return options[int(rng.integers(len(options)))]

    def prose(low: int, high: int) -> str:
        words: list[str] = []
        want = int(rng.integers(low, high))
        while len(words) < want:
            words += one(texts).split()[: want - len(words)] or ["a"]
        return " ".join(words)

    out: list[Block] = []

    def put(label: int, path: tuple, text: str, linked: bool = False) -> None:
        if text:
            out.append(Block(path, text, len(text) if linked else 0, label))

    def often(p: float) -> bool:
        return rng.random() < p

    wrap = [one(["div.page", "div.wrapper", "div.container", "div.site", "div.layout", "div", "section"])] if often(0.5) else []
    main = one(
        [["article"], ["main"], ["main", "article"], ["article.post"], ["div.content"], ["div.main-content"], ["div.post", "div.entry-content"],
         ["div.article-body"], ["div.story"], ["section.content"], ["div.text"], ["div.post-content"], ["div.main", "div.body"], ["section", "article"]]
    )
    head = one([["header"], ["div.header"], ["header.site-header"], ["div.top"], ["div.masthead"]])
    menu = one([["nav"], ["nav.main-nav"], ["div.menu"], ["div.navbar"], ["header", "nav"], ["div.navigation"], ["ul.nav"]])
    if often(0.4):
        for _ in range(int(rng.integers(1, 4))):
            put(0, _path(*wrap, one(["div.cookie-notice", "div.notice", "div.banner", "aside.consent", "div.cookies", "dialog"]), one(["p", "div", "span"])), one(NOTICES))
    if often(0.5):
        put(0, _path(*wrap, *head, one(["h1", "p", "div"])), prose(1, 6), often(0.5))
        if often(0.5):
            put(0, _path(*wrap, *head, "p"), prose(2, 12))
    if often(0.85):
        for _ in range(int(rng.integers(2, 10))):
            put(0, _path(*wrap, *menu, "ul", "li"), prose(1, 3), often(0.9))
    if often(0.3):
        put(0, _path(*wrap, one(["div.breadcrumb", "nav.breadcrumbs", "ol.breadcrumb"])), prose(2, 6), often(0.5))

    def advert() -> None:
        put(0, _path(*wrap, *(main if often(0.3) else []), one(["div.ad", "div.ads", "aside.advert", "div.promo", "div.sponsored", "div.banner"]), *(["p"] if often(0.3) else [])), prose(3, 30), often(0.2))

    def side() -> None:
        column = one([["aside"], ["div.sidebar"], ["aside.sidebar"], ["div.related"], ["section.recommended"], ["div.widget"]])
        put(0, _path(*wrap, *column, one(["h2", "h3", "h4", "p"])), one(SIDE))
        for _ in range(int(rng.integers(1, 6))):
            put(0, _path(*wrap, *column, *one([["ul", "li"], ["p"], ["div"]])), prose(2, 25), often(0.6))

    if often(0.5):
        advert()
    if often(0.2):
        side()
    put(1, _path(*wrap, *main, *(["header"] if often(0.1) else []), one(["h1", "h1", "h2"])), prose(3, 15))
    for _ in range(int(rng.integers(1, 14))):
        kind = rng.random()
        if kind < 0.74:
            put(1, _path(*wrap, *main, "p"), prose(3, 90))
        elif kind < 0.80:
            put(1, _path(*wrap, *main, one(["h2", "h3"])), prose(1, 9))
        elif kind < 0.85:
            for _ in range(int(rng.integers(1, 5))):
                put(1, _path(*wrap, *main, one(["ul", "ol"]), "li"), prose(1, 20), often(0.1))
        elif kind < 0.90:
            put(1, _path(*wrap, *main, *one([["blockquote"], ["blockquote", "p"], ["pre"], ["figure", "figcaption"], ["table", "tr", "td"], ["div"], ["section", "p"], ["dl", "dd"]])), prose(3, 40))
        elif kind < 0.95:
            advert()
        else:
            put(0, _path(*wrap, *main, one(["div.share", "ul.social", "div.related", "aside", "form.newsletter"]), one(["p", "li", "div"])), one(SIDE + FORMS), often(0.5))
    if often(0.35):
        side()
    if often(0.4):
        talk = one([["div.comments"], ["section.comments"], ["div.comment-list", "ol"], ["section.discussion"], ["div.replies"]])
        put(0, _path(*wrap, *talk, one(["h2", "h3"])), one(["Comments", "Discussion", "What readers say", "Replies"]))
        for _ in range(int(rng.integers(1, 7))):
            put(0, _path(*wrap, *talk, *one([["div.comment", "p"], ["article.comment", "p"], ["li.comment"], ["div.reply", "div"], ["p"]])), prose(2, 70))
    if often(0.3):
        for _ in range(int(rng.integers(1, 4))):
            put(0, _path(*wrap, one(["form", "form.search", "div.newsletter", "div.login", "div.subscribe"]), one(["p", "div", "label"])), one(FORMS))
    if often(0.85):
        foot = one([["footer"], ["div.footer"], ["footer.site-footer"], ["div.bottom", "footer"]])
        for _ in range(int(rng.integers(1, 5))):
            put(0, _path(*wrap, *foot, *one([[], ["p"], ["ul", "li"], ["div"]])), one(FOOT) + " " + prose(0, 8) if often(0.7) else prose(1, 14), often(0.4))
    return out


def train_labeller(pages: DataFrame, most_pages: int = TRAINING_PAGES, made: int = MADE_PAGES, most_chars: int = TRAINING_CHARS) -> BlockLabeller:
    """A labeller for ``pages(page_id, html)``.

    At most ``most_pages`` pages of at most ``most_chars`` characters, those whose id has the smallest hash, go to the
    driver, so that training has a bound at any size; of rows with one id, the smallest page. Of these, pages of over
    ``TRAINING_BLOCKS`` blocks are left out. Without any such page it learns from made-up pages alone.
    """
    usable = pages.where("page_id IS NOT NULL").where(F.length("html") <= most_chars).select("page_id", "html")
    chosen = usable.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(most_pages)
    rows = usable.join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min("html").alias("html")).toArrow()
    rows = rows.sort_by([("page_id", "ascending")])
    rng = np.random.default_rng(SEED)
    real, texts = [], []
    for page in rows.column("html").to_pylist():
        blocks = blocks_of(page)
        if len(blocks) > TRAINING_BLOCKS:
            continue
        labels = [told_label(b) for b in blocks]
        texts += [b.text for b in blocks if len(b.text) > 60]
        if any(labels):  # some main text is told
            for b, known in zip(blocks, labels):
                b.label = known or 0
            real.append(blocks)
    texts = texts or FALLBACK_TEXTS
    features = Features()
    samples = [(features.of(p), np.array([b.label for b in p], np.float32)) for p in [*real, *(made_page(rng, texts) for _ in range(made))] if p]
    model = BlockLabeller.new(rng)
    model.fit(samples, EPOCHS, RATE, rng)
    return model


def extract_main_text(pages: DataFrame, model: BlockLabeller | None = None) -> DataFrame:
    """``page_id, url, text, n_chars`` of each row of ``pages(page_id, url, html)``.

    ``text`` joins the blocks that the labeller takes for main text, in page order, by an empty line;
    none makes an empty text, and so do null and empty pages. Null ids and urls and
    repeated rows stay; other columns are not read; an empty table gives an empty result. Pages are read whole, where they
    lie; a very long one in parts, with its text and blocks in memory, but vectors of no more than some thousand blocks.
    """
    weights = (model or train_labeller(pages)).weights
    schema = "page_id long, url string, text string, n_chars long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller, features = BlockLabeller(weights), Features()
        for batch in batches:
            for part in slices(batch, "html"):
                pages = [blocks_of(x or "") for x in part.column("html").to_pylist()]
                kept = labeller.label_blocks(pages, features)
                texts = ["\n\n".join(b.text for b, k in zip(p, keep) if k) for p, keep in zip(pages, kept)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, schema)
