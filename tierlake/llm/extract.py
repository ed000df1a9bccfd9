"""Main text of HTML pages: flat blocks classified by a decision tree."""

import html
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tierlake.llm.html_samples import PAGES

# Names of HTML elements, and words in class names and ids.
OUTSIDE = (None, 0, 0, False, False, False)  # element, hint, in main, keep, unseen, in an aside
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p "
    "pre search section select summary table tbody td tfoot th thead title tr ul".split())
UNSEEN = frozenset(
    "script style noscript template svg math iframe object embed head title textarea select button canvas "
    "audio video map datalist".split())
RAW = frozenset("script style textarea title iframe noscript".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
CLOSED_BY_LIKE = frozenset("li dd dt td th tr option".split())
BOILERPLATE = frozenset("nav header footer aside menu dialog search".split())
FORMS = frozenset("form fieldset".split())  # now and then around a whole page
MAIN = frozenset("article main".split())
# Words in the names of wrappers. Those of the first kind also name the layout around a main text.
LAYOUT_WORDS = frozenset(
    "banner breadcrumb breadcrumbs footer header masthead menu nav navbar navigation share sharing sidebar social "
    "toolbar widget widgets complementary contentinfo".split())
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements comment comments cookie cookies consent disqus disclaimer "
    "modal newsletter notice notices popup promo promoted promotion related recommended replies reply respond "
    "sponsor sponsored subscribe alert".split())
TITLE_WORDS = frozenset("header masthead banner".split())
# A name that begins or ends like this tells of a state or a layout: has-sidebar, nav-closed.
STATE_FIRST = frozenset("has with no without not is show hide enable disable layout".split())
STATE_LAST = frozenset("closed open opened collapsed expanded enabled disabled active inactive visible on off layout".split())
NOT_SHOWN = re.compile(r"display\s*:\s*none", re.I)

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")

FEATURES = ["words", "links", "words_before", "links_before", "words_after", "links_after",
            "hint", "in_main", "heading", "plain_share"]
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())


class Block:
    """A flat block: its text, its words in links, and what it lies in.

    ``hint`` is 0 where no wrapper is named or made like boilerplate, 1 where one named like a layout
    is around the main element, 2 where a wrapper's name, 3 where its element says so.
    """

    __slots__ = ("parts", "link_words", "hint", "in_main", "keep", "heading", "text", "words")

    def __init__(self, hint, in_main, keep, heading=0):
        self.parts, self.link_words = [], 0
        self.hint, self.in_main, self.keep, self.heading = hint, in_main, keep, heading


def blocks(page):
    """The page's blocks with visible text, in page order.

    A block ends where a block element begins or ends; ``br`` is white space. Elements that
    are not shown are left out; a cut-off tag or comment at the end of the page is no text.
    """
    found, stack, links, at, n = [], [], 0, 0, len(page)
    block = Block(0, 0, False)

    def end_block():
        nonlocal block
        text = " ".join(html.unescape("".join(block.parts)).split()) if block.parts else ""
        if text:
            block.text, block.words = text, text.count(" ") + 1
            found.append(block)
        top = stack[-1] if stack else OUTSIDE
        block = Block(*top[1:4], int(top[0] in HEADINGS))

    def text(piece):
        if piece and not (stack and stack[-1][4]):
            block.parts.append(piece)
            if links:
                block.link_words += len(piece.split())

    while at < n:
        tag = TAG.search(page, at)
        if tag is None:
            text(page[at:])
            break
        text(page[at:tag.start()])
        at = tag.end()
        closing = tag[1] if tag[2] else tag[4]
        name = (tag[2] or tag[5] or "").lower()
        if not name:
            continue
        attributes = tag[3] or tag[6] or ""
        if name == "a":
            links = max(links + (-1 if closing else 1), 0)
            continue
        if name == "br":
            block.parts.append(" ")
            continue
        if name not in BLOCKS and name not in UNSEEN and not closing:
            if name in VOID or not attributes:
                continue
        if closing:
            depth = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] == name), None)
            if name in BLOCKS or name in UNSEEN:
                end_block()
            if depth is not None:
                del stack[depth:]
                if not block.parts:
                    end_block()
            continue
        if name in BLOCKS:
            end_block()
            while stack and (stack[-1][0] == "p" or (stack[-1][0] == name and name in CLOSED_BY_LIKE)):
                stack.pop()
        _, hint, in_main, keep, unseen, aside = stack[-1] if stack else OUTSIDE
        given = _attributes(attributes) if attributes else {}
        named = _named(given) if given else frozenset()
        main = name in MAIN or given.get("role", "").lower() == "main"
        if main and hint == 2 and not aside:
            hint = 1
        if name in BOILERPLATE and not (name == "header" and in_main):
            hint = 3
        elif named & ASIDE_WORDS and name not in ("html", "body", "main"):
            hint, aside = max(hint, 2), True
        elif (name in FORMS or named - (TITLE_WORDS if in_main else frozenset()) & LAYOUT_WORDS) and (
                name not in ("html", "body") and not main):
            hint = max(hint, 2)
        in_main = 1 if main else in_main
        style = NOT_SHOWN.search(given.get("style", ""))
        unseen = bool(unseen or name in UNSEEN or "hidden" in given or style
                      or given.get("aria-hidden", "").strip().lower() == "true")
        keep = keep or "data-keep" in given
        if name in RAW:
            close = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = close.start() if close else n
        if name not in VOID and not attributes.endswith("/"):
            stack.append((name, hint, in_main, keep, unseen, aside))
            if name in BLOCKS:
                block = Block(hint, in_main, keep, int(name in HEADINGS))
    end_block()
    return found


def _attributes(text):
    """Attributes of a tag by their lower-case names; the first of a name counts."""
    found = {}
    for name, *values in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), "".join(values))
    return found


def _named(attributes):
    """The words in a tag's class, id and role, but for names that tell of a state or a layout."""
    words = set()
    for name in " ".join(attributes.get(key, "") for key in ("class", "id", "role")).split():
        parts = re.split(r"[-_:]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower().strip("-_"))
        if len(parts) == 1 or not (parts[0] in STATE_FIRST or parts[-1] in STATE_LAST):
            words.update(parts)
    return words


def features(found):
    """One row of ``FEATURES`` per block; before the first and after the last block are zeros."""
    words = np.array([0, *[b.words for b in found], 0], float)
    links = np.array([0, *[min(b.link_words / b.words, 1.0) for b in found], 0], float)
    flags = np.array([(b.hint, b.in_main, b.heading) for b in found], float).reshape(-1, 3)
    # Of the words that could be main text, the share outside of wrappers named like a layout.
    text = (links[1:-1] < 0.5) * words[1:-1]
    plain, wrapped = text[flags[:, 0] == 0].sum(), text[flags[:, 0] == 1].sum()
    share = plain / max(plain + wrapped, 1)
    return np.column_stack([
        words[1:-1], links[1:-1], words[:-2], links[:-2], words[2:], links[2:], flags, np.full(len(found), share)])


# --- the decision tree ---------------------------------------------------------


def grow(rows, labels, depth=10, least=5):
    """A binary decision tree by Gini impurity: ``(feature, threshold, low, high)`` or a share."""
    share = float(labels.mean())
    if depth == 0 or share in (0.0, 1.0) or len(labels) < 2 * least:
        return share
    best = None
    for feature in range(rows.shape[1]):
        order = np.argsort(rows[:, feature], kind="stable")
        values, ones = rows[order, feature], np.cumsum(labels[order])
        n = np.arange(1, len(values))
        p, q = ones[:-1] / n, (ones[-1] - ones[:-1]) / (len(values) - n)
        impurity = n * p * (1 - p) + (len(values) - n) * q * (1 - q)
        impurity[(values[1:] == values[:-1]) | (n < least) | (len(values) - n < least)] = np.inf
        at = int(np.argmin(impurity)) if len(impurity) else 0
        if len(impurity) and impurity[at] < np.inf and (best is None or impurity[at] < best[0] - 1e-12):
            best = impurity[at], feature, (values[at] + values[at + 1]) / 2
    if best is None or best[0] >= len(labels) * share * (1 - share) - 1e-12:
        return share
    _, feature, threshold = best
    low = rows[:, feature] <= threshold
    return (feature, threshold, grow(rows[low], labels[low], depth - 1, least),
            grow(rows[~low], labels[~low], depth - 1, least))


def decide(tree, rows):
    """Whether each row is main text."""
    if not isinstance(tree, tuple):
        return np.full(len(rows), tree > 0.5)
    feature, threshold, low, high = tree
    return np.where(rows[:, feature] <= threshold, decide(low, rows), decide(high, rows))


def labelled_table(variants=40):
    """``(features, labels)`` of the labelled pages and of variants of them.

    Length says little where the place of a block, or its links, tell what it is; so a variant
    gives the blocks in a main element or in a boilerplate one, blocks of links, and some
    paragraphs other lengths, and leaves out what comes before or after the main text now
    and then.
    """
    draw = np.random.Generator(np.random.PCG64(11))
    rows, labels = [], []
    for page in PAGES:
        for variant in range(variants):
            found = blocks(page)
            if variant:
                for block in found:
                    links = block.link_words > 0.5 * block.words
                    if block.in_main or block.hint or links or (block.keep and draw.random() < 0.25):
                        words = int(draw.integers(1, 30 if links else 60))
                        block.link_words = round(block.link_words * words / block.words)
                        block.words = words
                kept = [i for i, block in enumerate(found) if block.keep]
                low = kept[0] if draw.random() < 0.2 else 0
                high = kept[-1] + 1 if draw.random() < 0.2 else len(found)
                found = found[low:high]
            rows.append(features(found))
            labels += [block.keep for block in found]
    return np.concatenate(rows), np.array(labels, float)


@lru_cache(maxsize=1)
def trained():
    """The tree of the labelled table."""
    return grow(*labelled_table())


def main_text(page, tree=None):
    """The main-text blocks of a page, one per line; null and pages without any: empty."""
    found = blocks(page or "")
    if not found:
        return ""
    kept = decide(tree or trained(), features(found))
    return "\n".join(b.text for b, keep in zip(found, kept) if keep)


def extract(pages, id_column="page_id", url_column="url", html_column="html"):
    """``(id, url, text, n_chars)`` of every row of ``pages``; other columns are ignored.

    Each page is handled by itself: nothing is shuffled, and any page may repeat. The tree
    is grown once per Python worker from the labelled pages.
    """
    given = pages.select(
        F.col(id_column).alias("_id"), F.col(url_column).alias("_url"),
        F.col(html_column).cast("string").alias("_html"))
    kinds = {f.name: f.dataType.simpleString() for f in given.schema}

    def run(batches):
        for batch in batches:
            texts = [main_text(page) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["_id", "_url", "text"])

    made = given.mapInArrow(run, f"_id {kinds['_id']}, _url {kinds['_url']}, text string")
    return made.select(
        F.col("_id").alias(id_column), F.col("_url").alias(url_column), "text",
        F.length("text").cast("long").alias("n_chars"))
