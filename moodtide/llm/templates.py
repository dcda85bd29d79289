"""Main text of web pages by deducing each host's template from its pages.

A page is a row of tokens: the containers on its way (an element with its class and id, under those
above it) and its short texts under their container. A token's occurrence vector says how often it
occurs on each page of the host. Tokens with equal vectors form an equivalence class. Classes of
``MIN_CLASS`` tokens or more, on enough pages, may be of the template.

A vector as long as a host has pages would not fit, so a token keeps what its class is told by and
what adds up map-side: on how many pages it occurs, how often, and the exclusive-or of a hash of every
(page, count) pair. Tokens with all three equal are one class.

Pages are then read again with their host's classes. Of every two members a bit says which comes first
and another whether one holds the other, and-ed and or-ed over all pages and repetitions: where the two
differ, order or nesting do not agree. Members are taken out, the most contradicted first, until all
agree; a class that is too small then is rejected. What is left is the template: its containers nest by
their paths, and a text fills the slot of the innermost one around it.

A slot's kind comes from what fills it on all pages: menus are links, notices the same short text
everywhere (in a class with containers, on most of the distinct main texts), the article is the most text that is not linked; names like article or main are evidence
within that. Each page then keeps what fills the main slots, without what its elements name as menus,
notices, forms, comments and the like.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import stored

# A class has at least so many tokens; a container of it is on so many pages and on this part of the host's at
# least, a text on over half of them.
MIN_CLASS = 3
MIN_SUPPORT = 3
SUPPORT_PART = 0.1
# A repeated text is a notice only if it is short and on over half of a host's distinct main texts and PRIOR more without it.
PRIOR = 8
NOTICE_WORDS = 25
# A slot is one of the main ones with at least this part of the main text of the host's best slot (less if it
# is named as main), and at most so much of it linked.
MAIN_PART = 0.3
LINKED = 0.5
ROWS = 256
# Elements nested deeper than this lie in the container at that depth.
DEPTH = 256
# What a block lies in may be named as no main text: for certain, or by a name inside the main text, which counts
# only for blocks that are mostly links.
OUT, DOUBTFUL = 1, 2

# Elements of HTML.
DROPPED = frozenset("head script style noscript template svg math iframe object canvas audio video textarea select button "
                    "datalist dialog nav aside form footer menu".split())  # fmt: skip
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul head title".split()
)
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
LISTS = frozenset("ul ol dl table menu dir".split())
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"([A-Za-z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
# Elements of a text's own structure, which are no notices however often they repeat.
LASTING = frozenset("h1 h2 h3 h4 h5 h6 li dt dd td th caption figcaption summary legend blockquote pre".split())
# Words of a class, id or role that name what is no main text.
NAMED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|sidebar|side-bar|menu|nav|navbar|navigation|breadcrumbs?|footer|"
    r"site-header|page-header|masthead|cookies?|consent|gdpr|notices?|notifications?|announcement|disclaimer|alert|popup|modal|"
    r"overlay|comments?|commentlist|discussion|disqus|replies|respond|reviews|related|recommend\w*|teasers?|share|sharing|social|"
    r"newsletter|subscribe|signup|login|search|toolbar|topbar|pagination|pager|skip-link|widget|complementary|contentinfo|"
    r"hidden)(?:$|[\s_-])",
    re.I,
)
# Those of what is a header outside the main text, and of the main text.
HEADING = re.compile(r"(?:^|[\s_-])(?:header|top|logo|brand|tagline|copyright|legal)(?:$|[\s_-])", re.I)
MAIN = re.compile(r"(?:^|[\s_-])(?:article|articlebody|main|content|post|entry|story)(?:$|[\s_-])", re.I)
# Those of a class that name readers' comments, wherever they stand.
COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|respond)(?:$|[\s_-])", re.I)
UNSEEN = re.compile(r"(?:^|\s)hidden(?:\s|$)|display\s*:\s*none", re.I)
IN_HEAD = frozenset("title meta link script style base noscript template".split())


class Page:
    """The blocks of a page, in order: text, the container they lie in, whether what they lie in is named as no
    main text, how surely it is named as the main one (0 to 2), how many characters are linked, and the element."""

    def __init__(self, source: str | None) -> None:
        self.blocks: list[tuple[str, str, bool, int, int, str]] = []
        self.containers: dict[str, int] = {}
        # Where each container begins and ends, and where each block stands, in one count of both.
        self.spans: list[list] = []
        self.places: list[int] = []
        self.clock = 0
        self.stack: list[tuple[str, str, int, int]] = []
        self.heads = 0
        self.opened: list[list | None] = []
        self.text: list[str] = []
        self.linked: list[str] = []
        self.in_link = False
        self._read(source or "")
        self._flush()
        self._leave(0)

    def _read(self, source: str) -> None:
        at, end, lower = 0, len(source), None
        while at < end:
            tag = TOKEN.search(source, at)
            self._say(source[at : tag.start() if tag else end])
            if not tag:
                return
            at = tag.end()
            name = tag[2] or tag[5]
            if not name:
                continue
            name = name.lower()
            if tag[1] or tag[4]:
                self._close(name)
                continue
            self._open(name, tag[3] or tag[6] or "")
            if name in RAW:
                lower = lower if lower is not None else source.lower()
                close = lower.find(f"</{name}", at)
                if name == "title":
                    self._say(source[at : close if close >= 0 else end])
                at = close if close >= 0 else end

    def _say(self, text: str) -> None:
        if text:
            self.text.append(text)
            if self.in_link:
                self.linked.append(text)

    def _open(self, name: str, attributes: str) -> None:
        if name == "a":
            self.in_link = True
        elif name == "br":
            self._say(" ")
        if name not in BLOCKS and name not in DROPPED:
            return
        self._flush()
        if name in VOID:
            return
        if name not in IN_HEAD and self.heads:
            # A head that nothing closed ends where the body begins.
            self._leave(next(i for i, above in enumerate(self.stack) if above[0] == "head"))
        closed = CLOSES.get(name, ())
        while self.stack and (self.stack[-1][0] in closed or self.stack[-1][0] == "p" and name in BLOCKS):
            self._leave(len(self.stack) - 1)
        named = {key.lower(): a or b or c for key, a, b, c in ATTRIBUTE.findall(attributes)} if attributes.strip() else {}
        called = " ".join(named.get(key, "") for key in ("class", "id", "role", "itemprop"))
        _, above, dropped, main = self.stack[-1] if self.stack else ("", "", 0, 0)
        # A header outside the main text is the site's; body, html and main name the page, not a part of it.
        out = OUT if name in DROPPED or UNSEEN.search(attributes) or name == "header" and not main else 0
        if called.strip() and name not in ("html", "body", "main") and not out:
            if not main:
                out = OUT if NAMED.search(called) or HEADING.search(called) else 0
            elif COMMENTS.search(named.get("class", "")):
                out = OUT
            elif NAMED.search(called):
                out = DOUBTFUL
        dropped = OUT if OUT in (dropped, out) else dropped or out
        # An article says more than what is called main or content.
        if name == "article":
            main = 2
        elif not main and (name == "main" or called.strip() and name in ("div", "section", "td") and MAIN.search(called)):
            main = 1
        path = f"{above}>{name}"
        if called.strip():
            path += "." + ".".join(sorted(re.sub(r"[0-9]+", "0", called.replace(">", " ")).split()))
        # Blocks of running text are no containers: they take their container's place.
        container = path if len(self.stack) < DEPTH and name not in ("p", "li", "tr", "td", "th", "dt", "dd", "blockquote", "pre") and not re.fullmatch("h[1-6]", name) else above
        span = None
        if container != above:
            self.containers[container] = self.containers.get(container, 0) + 1
            span = [container, self._tick(), 0]
            self.spans.append(span)
        self.heads += name == "head"
        self.stack.append((name, container, dropped, main))
        self.opened.append(span)

    def _tick(self) -> int:
        self.clock += 1
        return self.clock

    def _leave(self, depth: int) -> None:
        """Ends the elements below ``depth``, the innermost first."""
        while len(self.stack) > depth:
            self.heads -= self.stack.pop()[0] == "head"
            span = self.opened.pop()
            if span:
                span[2] = self._tick()

    def _close(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        if name not in BLOCKS and name not in DROPPED:
            return
        self._flush()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == name:
                self._leave(i)
                return
            if self.stack[i][0] in LISTS and name in CLOSES:
                return

    def _flush(self) -> None:
        if self.text:
            text = " ".join(html.unescape("".join(self.text)).split())
            if text:
                element, container, dropped, main = self.stack[-1] if self.stack else ("", "", 0, 0)
                linked = len("".join(self.linked))
                out = dropped == OUT or dropped == DOUBTFUL and linked > LINKED * len(text)
                self.blocks.append((text, container, out, main, linked, element))
                self.places.append(self._tick())
            self.text, self.linked = [], []

    def notices(self) -> Iterator[tuple[str, str, int]]:
        """The short texts with their containers and places."""
        for (text, container, dropped, *_), place in zip(self.blocks, self.places, strict=True):
            if not dropped and text.count(" ") < NOTICE_WORDS:
                yield container, text, place


def host_of(url: str | None) -> str:
    found = re.match(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def token_id(*parts: str) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            found: dict[tuple[str, int, str | None], list[int]] = {}

            def add(host: str, page: str, token: int, container: str | None, times: int, found=found) -> None:
                row = found.setdefault((host, token, container), [0, 0, 0])
                row[0] += 1
                row[1] += times
                row[2] ^= token_id(page, str(times))

            for page_id, url, source in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                host, page, read = host_of(url), f"{page_id} {url}", Page(source)
                add(host, page, 0, "", 1)
                for container, times in read.containers.items():
                    add(host, page, token_id(container), container, times)
                texts: dict[int, int] = {}
                for container, text, _ in read.notices():
                    token = token_id(container, text)
                    texts[token] = texts.get(token, 0) + 1
                for token, times in texts.items():
                    add(host, page, token, None, times)
            yield _batch(((*key, *row) for key, row in found.items()), TOKENS)


TOKENS = {"host": pa.string(), "token": pa.int64(), "container": pa.string(), "pages": pa.int64(), "times": pa.int64(), "vector": pa.int64()}
FACTS = {"host": pa.string(), "kind": pa.string(), "token": pa.int64(), "word": pa.int64(), "every": pa.int64(), "some": pa.int64(),
         "chars": pa.int64(), "linked": pa.int64()}


def _batch(rows, types: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = [list(column) for column in zip(*rows, strict=True)] or [[] for _ in types]
    arrays = [pa.array(column, kind) for column, kind in zip(columns, types.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(types))


def _ddl(types: dict[str, pa.DataType]) -> str:
    return ", ".join(f"{name} {'string' if kind == pa.string() else 'bigint'}" for name, kind in types.items())


def relations(found: list[list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """Of each member of a class, from where each begins and ends on a page: the members that come before it
    (a bit each) and those that hold it (as many bits on), at all of its repetitions and at some."""
    size = len(found)
    full = (1 << 2 * size) - 1
    times = {len(places) for places in found}
    if len(times) != 1:
        return [(0, full)] * size
    every, some, last = [full] * size, [0] * size, []
    for n in range(times.pop()):
        unit = sorted((*places[n], j) for j, places in enumerate(found))
        before, around = 0, []
        for begin, end, j in unit:
            while around and around[-1][0] < begin:
                around.pop()
            mask = before
            for _, holder in around:
                mask |= 1 << size + holder
            every[j] &= mask
            some[j] |= mask
            # What begins before the last repetition is over stands in no order to what begins after it there.
            if last and begin < last[-1][0]:
                for other, _, i in last:
                    if other > begin:
                        every[j] &= ~(1 << i)
                        some[j] |= 1 << i
            before |= 1 << j
            around.append((end, j))
        last = unit
    return list(zip(every, some, strict=True))


def agreeing(relation: list[tuple[int, int]], first: list[bool]) -> list[int]:
    """The members left when the most contradicted are taken out until order and nesting agree on all
    pages; of those contradicted alike one that is ``first`` goes."""
    size = len(relation)
    against = [{j for j in range(size) if ((e ^ s) >> j | (e ^ s) >> size + j) & 1} for e, s in relation]
    for j, others in enumerate(against):
        others.discard(j)
        for i in others:
            against[i].add(j)
    left = set(range(size))
    while left:
        worst = max(left, key=lambda j: (len(against[j]), first[j], j))
        if not against[worst]:
            break
        left.remove(worst)
        for i in against[worst]:
            against[i].discard(worst)
    return sorted(left)


def holders(container: str) -> Iterator[str]:
    """A container and those around it, the page itself last."""
    while container:
        yield container
        container = container[: container.rfind(">")]
    yield ""


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            masks: dict[tuple[str, int], tuple[int, int]] = {}
            sums: dict[tuple[str, int], list[int]] = {}
            ids: dict[str, int] = {"": 0}
            sizes: dict[tuple[str, int], int] = {}
            # Copies of a text are told by its longest part.
            texts: set[tuple[str, int, int]] = set()
            for host, source, classes in zip(*(part.column(i).to_pylist() for i in range(3)), strict=True):
                page = Page(source)
                wanted = {token for tokens in classes for token in tokens}
                found: dict[int, list[tuple[int, int]]] = {}
                for container, begin, end in page.spans:
                    token = ids.get(container) or ids.setdefault(container, token_id(container))
                    if token in wanted:
                        found.setdefault(token, []).append((begin, end))
                longest = ""
                for text, container, dropped, _, linked, _ in page.blocks:
                    if not dropped:
                        longest = text if not linked and len(text) > len(longest) else longest
                        slot = next(t for t in (ids[c] for c in holders(container)) if t in wanted or not t)
                        row = sums.setdefault((host, slot), [0, 0])
                        row[0] += len(text)
                        row[1] += linked
                for container, text, place in page.notices():
                    token = token_id(container, text)
                    if token in wanted:
                        found.setdefault(token, []).append((place, place))
                        texts.add((host, token, token_id(longest)))
                texts.add((host, 0, token_id(longest)))
                for tokens in classes:
                    if any(token in found for token in tokens):
                        related = relations([found.get(token, []) for token in tokens])
                        for token, (every, some) in zip(tokens, related, strict=True):
                            sizes[host, token] = len(tokens)
                            e, s = masks.get((host, token), (every, some))
                            masks[host, token] = e & every, s | some
            rows = [(host, "slot", slot, 0, 0, 0, *row) for (host, slot), row in sums.items()]
            rows += [(host, "text", token, text, 0, 0, 0, 0) for host, token, text in texts]
            for (host, token), (every, some) in masks.items():
                for word in range((2 * sizes[host, token] + 31) // 32):
                    low = [x >> 32 * word & 0xFFFFFFFF for x in (every, some)]
                    rows.append((host, "order", token, word, *low, 0, 0))
            yield _batch(rows, FACTS)


def named_main(container: str) -> tuple[int, str]:
    """How surely a container is named as the main text (2 an article), and the outermost one that is, if any."""
    level, outermost = 0, ""
    for inner in reversed(list(holders(container))[:-1]):
        name, _, called = inner[inner.rfind(">") + 1 :].partition(".")
        if name == "article" or name == "main" or name in ("div", "section", "td") and MAIN.search(called.replace(".", " ")):
            outermost = outermost or inner
            level = max(level, 2 if name == "article" else 1)
    return level, outermost


def main_slots(slots: dict[str, tuple[int, int, int]]) -> set[str]:
    """The main ones of some slots: a container each with the pages it is on, characters and linked ones.

    How much unlinked text a slot gets decides; names count as evidence: a named slot needs less text, one named as
    an article is no menu, and what lies in the same named element as a main slot is main too. So is what
    nests in a main slot, unless that is a mere wrapper of another with more text.
    """
    names = {slot: named_main(slot) for slot in slots}
    menus = {slot for slot, (_, chars, linked) in slots.items() if linked > LINKED * chars and names[slot][0] < 2}
    text = {slot: (chars - linked * (names[slot][0] < 2)) / pages for slot, (pages, chars, linked) in slots.items() if chars}
    free = {slot: chars for slot, chars in text.items() if slot not in menus} or {slot: slots[slot][1] for slot in text}
    most = max(free.values(), default=0)
    main = {slot for slot, chars in free.items() if chars * (1 + names[slot][0]) >= MAIN_PART * most}
    parts = {names[slot][1] for slot in main} - {""}
    whole = {
        slot for slot in main
        if slot[slot.rfind(">") + 1 :].partition(".")[0] not in ("", "html", "body")
        and not any(other.startswith(slot + ">") and free[other] > free[slot] for other in main)
    }
    return main | {
        slot for slot in slots
        if slot not in menus and (names[slot][1] in parts or any(slot.startswith(outer + ">") for outer in whole))
    }


def _template(rows: pa.Table) -> pa.Table:
    """One host's template from its candidates' members (kind ``member``, class in ``word``), what is known
    of their order, and what fills their slots."""
    facts = rows.to_pylist()
    host, of = facts[0]["host"], facts[0]["of"]
    members = {r["token"]: r for r in facts if r["kind"] == "member"}
    masks: dict[int, list[int]] = {}
    for r in facts:
        if r["kind"] == "order":
            mask = masks.setdefault(r["token"], [0, 0])
            mask[0] |= r["every"] << 32 * r["word"]
            mask[1] |= r["some"] << 32 * r["word"]
    classes: dict[int, list[int]] = {}
    for token in sorted(members):
        classes.setdefault(members[token]["word"], []).append(token)
    texts = {r["token"]: r["n"] for r in facts if r["kind"] == "text"}
    template: set[int] = set()
    notices: list[int] = []
    for tokens in classes.values():
        left = agreeing([tuple(masks[t]) for t in tokens], [members[t]["container"] is None for t in tokens])
        if len(left) >= MIN_CLASS:
            template.update(tokens[j] for j in left)
            # Only what comes as often as a part of the page, whatever the page's text is, is no part of that text.
            if any(members[tokens[j]]["container"] for j in left):
                repeated = (tokens[j] for j in left if members[tokens[j]]["container"] is None)
                notices += [t for t in repeated if 2 * texts.get(t, 0) > texts[0] + PRIOR]
    known = {"": (0, of)} | {members[t]["container"]: (t, members[t]["pages"]) for t in template if members[t]["container"]}
    fill = {slot: [0, 0] for slot in known}
    for r in facts:
        if r["kind"] == "slot":
            # What filled a container that was taken out fills the slot around it.
            at = next(c for c in holders(members[r["token"]]["container"] if r["token"] else "") if c in known)
            fill[at][0] += r["chars"]
            fill[at][1] += r["linked"]
    main = main_slots({slot: (known[slot][1], *sums) for slot, sums in fill.items()}) if len(known) > 1 else set()
    made = {"host": [host], "template": [sorted(t for t, _ in known.values())], "slots": [sorted(known[c][0] for c in main)],
            "notices": [sorted(notices)]}
    tokens = pa.list_(pa.int64())
    return pa.table(made, pa.schema([("host", pa.string()), ("template", tokens), ("slots", tokens), ("notices", tokens)]))


def templates(pages: DataFrame) -> DataFrame:
    """``host, template, slots, notices``: the tokens of a host's template containers (0 the page itself), which
    of them are main slots, and its repeated short texts, from ``page_id, url, html``. Hosts without a class
    that is large enough have no row.

    A host's rows are as many as its template has tokens (and their order's bits by its square), which its
    pages' size bounds.
    """
    spark = pages.sparkSession
    tokens = pages.mapInArrow(_tokens, _ddl(TOKENS)).groupBy("host", "token", "container").agg(
        F.sum("pages").alias("pages"), F.sum("times").alias("times"), F.expr("bit_xor(vector)").alias("vector"),
    )
    classes = spark.sql(
        f"""
        WITH hosts AS (SELECT host, pages AS of FROM {{tokens}} WHERE token = 0 AND container = ''),
        frequent AS (
          SELECT t.*, h.of FROM {{tokens}} t JOIN hosts h ON t.host = h.host
          WHERE t.pages >= {MIN_SUPPORT} AND t.pages >= h.of * CASE WHEN container IS NULL THEN 0.5 ELSE {SUPPORT_PART} END
            AND (container IS NOT NULL OR 2 * t.pages > h.of) AND NOT (t.token = 0 AND t.container = '')
        )
        SELECT host, pages, max(of) AS of, sort_array(collect_list(token)) AS tokens,
               collect_list(struct(token, container)) AS members
        FROM frequent GROUP BY host, pages, times, vector HAVING count(*) >= {MIN_CLASS}
        """,
        tokens=stored(tokens.filter("pages > 1 OR token = 0"), "page-tokens"),
    )
    classes = stored(classes, "page-classes")
    wanted = stored(classes.groupBy(F.col("host").alias("_of")).agg(F.sort_array(F.collect_list("tokens")).alias("classes")), "page-wanted")
    rows = pages.withColumn("host", _host("url")).join(wanted, F.col("host") == F.col("_of")).select("host", "html", "classes")
    facts = rows.mapInArrow(_facts, _ddl(FACTS)).groupBy("host", "kind", "token", "word").agg(
        F.expr("bit_and(every)").alias("every"), F.expr("bit_or(some)").alias("some"), F.sum("chars").alias("chars"),
        F.sum("linked").alias("linked"),
    )
    # The texts that a token stands beside are one row each up to here, and counted now.
    facts = facts.groupBy("host", "kind", "token", F.when(F.col("kind") != "text", F.col("word")).alias("word")).agg(
        F.count("*").alias("n"), F.max("every").alias("every"), F.max("some").alias("some"), F.max("chars").alias("chars"),
        F.max("linked").alias("linked"),
    )
    members = classes.select("host", "pages", "of", F.xxhash64("tokens").alias("word"), F.inline("members"))
    members = members.withColumn("kind", F.lit("member"))
    both = members.unionByName(facts, allowMissingColumns=True)
    of = members.groupBy(F.col("host").alias("_of")).agg(F.max("of").alias("_pages"))
    both = both.join(of, F.col("host") == F.col("_of")).withColumn("of", F.col("_pages")).drop("_of", "_pages")
    return both.groupBy("host").applyInArrow(_template, "host string, template array<bigint>, slots array<bigint>, notices array<bigint>")


def _host(url: str):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))


def _notice_like(block: tuple) -> bool:
    """Whether a block may be a notice: short, not in what is named as the main text, no heading, no item."""
    text, _, _, main, _, element = block
    return not main and text.count(" ") < NOTICE_WORDS and element not in LASTING


def main_text(source: str | None, slots: list[int], notices: set[int], template: list[int] | None = None) -> str:
    """What fills a page's main slots. A page of another kind than its host's, with most of its unlinked text in
    other places, or of a host without a template, gives the main ones of its own containers too."""
    kept = [block for block in Page(source).blocks if not block[2]]
    kept = [b for b in kept if not _notice_like(b) or token_id(b[1], b[0]) not in notices]
    around = {b[1]: list(holders(b[1])) for b in kept}
    chosen: set[str] = set()
    if slots:
        known, main = {0, *(template or ())}, set(slots)
        ids = {"": 0} | {c: token_id(c) for above in around.values() for c in above if c}
        chosen = {c for c, above in around.items() if next(t for t in map(ids.get, above) if t in known) in main}
    free = [(len(b[0]) - b[4] * (b[3] < 2), b[1] in chosen) for b in kept]
    if not chosen or sum(n for n, main in free if main) < MAIN_PART * sum(n for n, _ in free):
        sums: dict[str, list[int]] = {}
        for text, container, _, _, linked, _ in kept:
            row = sums.setdefault(container, [1, 0, 0])
            row[1] += len(text)
            row[2] += linked
        chosen |= main_slots({container: tuple(row) for container, row in sums.items()})
    return "\n\n".join(block[0] for block in kept if block[1] in chosen)


def page_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars``: one row per row of ``pages``.

    Null and empty pages have an empty text. Pages without a host in their address form one. Rows may repeat
    and ids be null; an empty table gives no rows; other columns are not read. Pages are read twice: what
    is kept between is one small row per host, which Spark broadcasts if it is under its limit.
    """
    narrow = pages.select(
        F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    known = stored(templates(narrow), "page-templates").withColumnRenamed("host", "of")
    rows = narrow.withColumn("host", _host("url"))
    rows = rows.join(known, rows.host == known.of, "left").select("page_id", "url", "html", "slots", "notices", "template")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                columns = zip(*(part.column(i).to_pylist() for i in (2, 3, 4, 5)), strict=True)
                texts = [main_text(source, slots or [], set(notices or []), known) for source, slots, notices, known in columns]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
                )

    texts = rows.mapInArrow(run, "page_id bigint, url string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
