"""Main text of HTML pages by a tree-structured graphical model over the DOM.

Every block element is a node with a hidden label: main text or not. Its tag, its class and id words and the shape of
its own text speak for a label; a table of parent-child potentials ties it to its parent. Sum-product messages pass up
the tree and down again and give each node's exact marginal.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.batches import add_columns
from reviewlake.llm.labelled_pages import FILLERS, LAYOUTS

#: A comment, a declaration, or a tag with its name and attributes; a `<` that begins none of them is text. Quotes count
#: after `=` only, and what is never closed runs to the page's end, so that no start of a tag is tried in vain.
MARKUP = re.compile(r"""<!--(?:.*?)(?:--!?>|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)"""
                    r"""((?:[^=>]++|=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|[^\s>"'][^\s>]*+)?+)*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())

#: Elements whose content is no text of the page; up to their end tag nothing is markup.
RAW = set("script style noscript template title textarea iframe noembed noframes xmp".split())
HIDDEN = set("head select button svg object audio video canvas datalist".split())

#: Start tags that leave <head> open; any other one, and text, ends it.
IN_HEAD = set("base link meta title noscript noframes style script template head".split())

#: Blocks that a list of choices holds.
CHOICES = set("option optgroup hr".split())

BLOCKS = set("address article aside blockquote body center caption dd details dialog dir div dl dt fieldset figcaption figure footer form "
             "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
             "summary table tbody td tfoot th thead tr ul".split())

#: Kinds of blocks by how readily they differ from their parent; all others, as paragraphs, are "text".
REGIONS = set("article aside body div footer form header main nav section fieldset details dialog".split())
KINDS = {"region": REGIONS, "list": set("ul ol dl menu dir".split()), "table": set("table tbody thead tfoot tr td th".split())}
KIND_OF = {tag: kind for kind, tags in KINDS.items() for tag in tags}

#: A start tag ends open elements of these names, down to the nearest of the second set.
CLOSES = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
          "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}

#: Powers of the features' likelihoods: blocks of one part look alike, so the shape of each says less than it seems to.
POWERS = {"tag": 0.8, "word": 1.5, "size": 0.5, "links": 0.8}

WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


@dataclass
class Node:
    """A block: its parent's number, tag, words of its attributes, own texts in page order, and characters in links."""

    parent: int
    tag: str
    words: list[str] = field(default_factory=list)
    mark: str = ""
    texts: list[int] = field(default_factory=list)
    size: int = 0
    linked: int = 0
    stop: bool = False


def raw_end(source: str, name: str, at: int) -> int:
    """Where the content of a raw element, which starts at `at`, and its end tag are over."""
    end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
    return end.end() if end else len(source)


def unclosed(source: str, at: int) -> set[int]:
    """Ends of those start tags of hidden elements, from `at` on, that have no end tag."""
    opened: dict[str, list[int]] = {name: [] for name in HIDDEN}
    while found := MARKUP.search(source, at):
        at = found.end()
        closing, name = found.group(1), (found.group(2) or "").lower()
        if name in RAW and not closing:
            at = raw_end(source, name, at)
        elif name in HIDDEN:
            if not closing and not found.group(3).endswith("/"):
                opened[name].append(at)
            elif closing and opened[name]:
                opened[name].pop()
    return {end for ends in opened.values() for end in ends}


def parse(source: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """The blocks of a page, parents first, and its texts in page order with the numbers of their blocks.

    Character references are decoded and white space is one space. Missing end tags are implied as browsers do; a
    hidden element without an end tag hides what comes up to the next block, or its next namesake, only.
    """
    nodes = [Node(-1, "html")]
    texts: list[tuple[int, str]] = []
    stack: list[tuple[str, int]] = [("html", 0)]  # open elements and the block that their text belongs to
    places: dict[str, list[int]] = {"html": [0]}  # of the open elements of each name in the stack
    block_places = [-1]
    run: list[tuple[str, bool]] = []
    links = hidden = 0
    at = 0
    open_ended: set[int] | None = None  # found when the first hidden element starts
    loose: list[int] = []  # places in the stack of hidden elements without an end tag

    def end_run():
        if run:
            text = " ".join("".join(part for part, _ in run).split())
            if text:
                owner = nodes[stack[-1][1]]
                owner.texts.append(len(texts))
                owner.size += len(text)
                owner.linked += min(len(text), sum(len(part) for part, linked in run if linked))
                owner.stop = text[-1] in ".!?…。:;\"”"
                texts.append((stack[-1][1], text))
            run.clear()

    def pop():
        nonlocal links, hidden
        tag, _ = stack[-1]
        if tag in BLOCKS:
            end_run()
        stack.pop()
        places[tag].pop()
        if block_places[-1] == len(stack):
            block_places.pop()
        links -= tag == "a"
        hidden -= tag in HIDDEN
        if loose and loose[-1] == len(stack):
            loose.pop()

    def pop_to(size: int):
        while len(stack) > size:
            pop()

    def push(tag: str, block: int):
        nonlocal links, hidden
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS:
            block_places.append(len(stack))
        stack.append((tag, block))
        links += tag == "a"
        hidden += tag in HIDDEN

    def last(names) -> int:
        """The place of the innermost open element of some names; 0, which is the page, without one."""
        return max((places[name][-1] for name in names if places.get(name)), default=0)

    while at < len(source):
        found = MARKUP.search(source, at)
        start = found.start() if found else len(source)
        if hidden and stack[-1][0] == "head" and source[at:start].strip(" \t\n\f\r"):
            pop()
        if start > at and not hidden:
            run.append((entities.unescape(source[at:start]), links > 0))
        if not found:
            break
        at = found.end()
        closing, name, attributes = found.group(1), (found.group(2) or "").lower(), found.group(3) or ""
        if not name:
            continue
        if closing:
            if name == "br":
                run.append((" ", False))
            place = last((name,))
            if place > 0 and (name in BLOCKS or block_places[-1] < place):  # the end of an inline element does not end blocks
                pop_to(place)
            if name in BLOCKS:
                end_run()
            continue
        if hidden and stack[-1][0] == "head" and name not in IN_HEAD:
            pop()
        if name in RAW:
            at = raw_end(source, name, at)
            continue
        if name == "head" and len(stack) > len(places["html"]):
            continue
        if loose and name in BLOCKS and not (name in CHOICES and stack[loose[0]][0] in ("select", "datalist")):
            pop_to(loose[0])
        if name in BLOCKS:
            if name in CLOSES:
                names, bound = CLOSES[name]
                if (place := last(names)) > last(bound):
                    pop_to(place)
            if places.get("p") and (place := places["p"][-1]) > last(("table", "td", "button", "object")):
                pop_to(place)  # a block ends an open paragraph
            end_run()
            node = Node(stack[-1][1], name)
            if attributes:
                for key, *values in ATTRIBUTE.findall(attributes):
                    if key.lower() in ("class", "id", "role", "itemprop"):
                        node.words += [word.lower() for word in WORDS.findall("".join(values))]
                    elif key in ("main", "not"):
                        node.mark = key
            if name in VOID:
                continue
            nodes.append(node)
            push(name, len(nodes) - 1)
        elif name in VOID:
            if name == "br":
                run.append((" ", False))
        elif not attributes.endswith("/"):
            if name in HIDDEN and name != "head":
                for place in loose:
                    if stack[place][0] == name:
                        pop_to(place)
                        break
                if open_ended is None:
                    open_ended = unclosed(source, found.start())
                if at in open_ended:
                    loose.append(len(stack))
            push(name, stack[-1][1])
    while len(stack) > 1:
        pop()
    end_run()
    return nodes, texts


def features(node: Node, masked: bool = False) -> list[str]:
    """What speaks for a block's label; `masked` hides the meaning of its tag."""
    tag = "div" if masked and node.tag in REGIONS else node.tag
    out = [f"tag {tag}", *[f"word {word}" for word in sorted(set(node.words))]]
    if node.size:
        shape = "stop" if node.stop else "open"
        out.append(f"size {min(7, node.size.bit_length() - 3) if node.size > 7 else 0} {shape}")
        out.append(f"links {min(3, 4 * node.linked // node.size)}")
    return out


def group(node: Node) -> str:
    return KIND_OF.get(node.tag, "text")


def count_page(nodes: list[Node], labels: list[int], masked: bool, weight: int) -> Counter:
    """Counts of (label), (feature, label) and (group, parent's label, label)."""
    counts: Counter = Counter()
    for node, label in zip(nodes, labels):
        counts["label", "", "", label] += weight
        for name in features(node, masked):
            counts["feature", name, "", label] += weight
        if node.parent >= 0:
            counts["edge", group(node), str(labels[node.parent]), label] += weight
    return counts


def marked_labels(nodes: list[Node]) -> list[int]:
    """Labels of a hand-labelled layout."""
    labels: list[int] = []
    for node in nodes:
        above = labels[node.parent] if node.parent >= 0 else 0
        labels.append(1 if node.mark == "main" else 0 if node.mark == "not" else above)
    return labels


#: Elements, and class or id words, by which a page itself says that a part is not main text.
ASIDE_TAGS = set("nav aside footer form dialog menu".split())
ASIDE_WORDS = set("ad ads advert nav menu sidebar footer comments comment cookie notice banner promo related share newsletter".split())


def own_labels(nodes: list[Node]) -> list[int] | None:
    """Labels that a page gives itself by an <article> or <main> element; None without any."""
    if not any(node.tag in ("article", "main") for node in nodes):
        return None
    labels: list[int] = []
    for node in nodes:
        above = labels[node.parent] if node.parent >= 0 else 0
        aside = node.tag in ASIDE_TAGS or not ASIDE_WORDS.isdisjoint(node.words)
        labels.append(0 if aside else 1 if node.tag in ("article", "main") else above)
    return labels


def layout_counts(weight: int = 1) -> Counter:
    counts: Counter = Counter()
    for layout, s, m, l in product(LAYOUTS, FILLERS["s"], FILLERS["m"], FILLERS["l"]):
        nodes, _ = parse(layout.replace("{s}", s).replace("{m}", m).replace("{l}", l))
        for masked in (False, True):
            counts += count_page(nodes, marked_labels(nodes), masked, weight)
    return counts


class Model:
    """Log potentials by smoothed counts: of features for each label, and of labels given the parent's."""

    def __init__(self, counts: dict[tuple, float]):
        total = [counts.get(("label", "", "", label), 0) for label in (0, 1)]
        self.root = (math.log(0.9), math.log(0.1))
        self.evidence: dict[str, tuple[float, float]] = {}
        for name in {key[1] for key in counts if key[0] == "feature"}:
            power = POWERS[name.split()[0]]
            self.evidence[name] = tuple(power * math.log((counts.get(("feature", name, "", label), 0) + 1) / (total[label] + 2))
                                        for label in (0, 1))
        self.edges: dict[str, list[list[float]]] = {}
        for kind in (*KINDS, "text"):
            self.edges[kind] = []
            for above in (0, 1):
                seen = [counts.get(("edge", kind, str(above), label), 0) + 0.5 for label in (0, 1)]
                self.edges[kind].append([math.log(each / sum(seen)) for each in seen])

    def marginals(self, nodes: list[Node]) -> list[float]:
        """The probability of each block to be main text, given the whole page."""
        own, up = [], [(0.0, 0.0)] * len(nodes)
        for node in nodes:
            zero = one = 0.0
            for name in features(node):
                found = self.evidence.get(name)
                if found:
                    zero, one = zero + found[0], one + found[1]
            own.append([zero, one])
        for at in range(len(nodes) - 1, 0, -1):  # `own` gathers the children's messages
            edge, (zero, one) = self.edges[group(nodes[at])], own[at]
            up[at] = message = add(edge[0][0] + zero, edge[0][1] + one), add(edge[1][0] + zero, edge[1][1] + one)
            above = own[nodes[at].parent]
            above[0] += message[0]
            above[1] += message[1]
        belief = [(self.root[0] + own[0][0], self.root[1] + own[0][1])]
        for at in range(1, len(nodes)):
            above, edge = belief[nodes[at].parent], self.edges[group(nodes[at])]
            rest = above[0] - up[at][0], above[1] - up[at][1]  # the parent's belief without this child's message
            zero, one = (add(rest[0] + edge[0][label], rest[1] + edge[1][label]) + own[at][label] for label in (0, 1))
            norm = add(zero, one)
            belief.append((zero - norm, one - norm))
        return [1 / (1 + math.exp(max(-700.0, min(700.0, zero - one)))) for zero, one in belief]


def add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return a + math.log1p(math.exp(b - a)) if a >= b else b + math.log1p(math.exp(a - b))


def train(pages: DataFrame, html: str = "html", sample: int = 20_000, words: int = 20_000) -> Model:
    """Counts potentials over the hand-labelled layouts and those pages that label themselves.

    At most `sample` pages (those of least hash) are read for it, and `words` features kept; both sources count alike.
    """
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for part in parts:
            for value in part.column(0).to_pylist():
                nodes, _ = parse(value)
                labels = own_labels(nodes)
                if labels is not None:
                    for masked in (False, True):
                        counts += count_page(nodes, labels, masked, 1)
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([key[place] for key in keys], pa.string()) for place in range(3)]
                                         + [pa.array([key[3] for key in keys], pa.int32()),
                                            pa.array([counts[key] for key in keys], pa.int64())],
                                         ["kind", "name", "above", "label", "n"])
    hashed = pages.where(F.col(html).isNotNull()).select(F.xxhash64(html).alias("h"))
    bound = hashed.orderBy("h").limit(sample).agg(F.max("h")).first()[0]
    some = pages.where(F.col(html).isNotNull() & (F.xxhash64(html) <= F.lit(bound if bound is not None else 0))).select(html)
    found = (some.mapInArrow(run, "kind string, name string, above string, label int, n bigint")
             .groupBy("kind", "name", "above", "label").agg(F.sum("n").alias("n"))
             .orderBy(F.desc("n"), "kind", "name", "above", "label").limit(2 * words).collect())
    counts = {(row.kind, row.name, row.above, row.label): float(row.n) for row in found}
    given = layout_counts()
    seen = sum(value for key, value in counts.items() if key[0] == "label")
    scale = max(1.0, seen / sum(value for key, value in given.items() if key[0] == "label"))
    for key, value in given.items():
        counts[key] = counts.get(key, 0.0) + scale * value
    return Model(counts)


def main_text(source: str, model: Model, least: float = 0.5) -> tuple[str, float]:
    """The main text of a page, and the smallest certainty among its blocks with text."""
    nodes, texts = parse(source)
    chance = model.marginals(nodes)
    kept = [text for node, text in texts if chance[node] >= least]
    return "\n".join(kept), min((max(chance[node], 1 - chance[node]) for node, _ in texts), default=1.0)


def extract(df: DataFrame, model: Model, html: str = "html", least: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Adds text (blocks whose marginal is `least` or more, in page order, one to a line), n_chars and certainty.

    Null and empty pages, and pages without main text, have an empty text. Nothing is cut off, however long a page is.
    Row for row; repeated rows stay and columns named like new ones are replaced.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    def start():
        model = sent.value

        def rows(pages):
            found = [main_text(value or "", model, least) for value in pages]
            return [text for text, _ in found], [len(text) for text, _ in found], [sure for _, sure in found]
        return rows
    return add_columns(df, [html], "text string, n_chars bigint, certainty double", start, keep)
