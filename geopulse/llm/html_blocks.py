"""Main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags.  The first pass classifies a
block by its length, the share of its characters inside links and the density
of function words; blocks inside containers that never hold the article
(navigation, header and footer of the page, forms, notices, adverts, comments)
are boilerplate whatever they look like.  Short blocks stay undecided.  The
second pass gives an undecided block the label of its nearest decided
neighbours outside those containers: of both when they agree, else of the one
inside the same container, else of the nearer one.  Headings follow the block
after them; a page on which nothing is decided keeps its undecided blocks.

An ``article`` or ``main`` is a prior, not a decision: what the rules would put out there
(links, lists of names) stays undecided, and its undecided blocks look to the
article's own decided ones, or stay where it has none.

Reader comments are told by their container's name, or by their structure: sibling
containers with equal tag and class, most of which hold running text without a
heading, signed by a short block with a time, a date or a link to reply.

A container's name or form tag counts less than the page's structure: an
``article`` or ``main`` inside it starts afresh (not inside ``nav``, ``aside`` and
the like, not an article in an article, which is a comment), and a container that
holds most of the page's text, with next to no running text beside it, is judged
by its blocks.

Function words are listed by language, for Chinese, Japanese and Korean by
character; a block's density is that of its best language.  Where no block of a
page reaches it, its language has no list, and blocks stay undecided.

Defined results: a null or empty page, or one without a content block, gives an
empty text; broken markup (unclosed tags, a lone ``<``) is read as browsers do,
approximately; repeated rows give repeated results; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: HTML element names by role
BLOCK_TAGS = frozenset(
    "address article aside blockquote body br button center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html iframe legend li main menu nav ol optgroup option p pre section select summary "
    "table tbody td tfoot th thead title tr ul".split())
RAW_TAGS = frozenset("script style textarea title noscript template iframe svg math object".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BOILERPLATE_TAGS = frozenset("nav footer aside form menu head button select dialog fieldset".split())
HEADING_TAGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Boilerplate whatever they hold; the other containers may turn out to wrap the article.
FIXED_TAGS = frozenset("nav footer aside menu head header button select dialog".split())
#: Words in class, id or role that name a container without article text.
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "commentlist copyright discussion discussions disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promoted related replies reply respond search share sharing sidebar signup social "
    "sponsor sponsored subscribe subscription toolbar topbar widget contentinfo complementary alert legal".split())
ARTICLE_TAGS = frozenset("article main".split())
ARTICLE_WORDS = frozenset("article post entry story content".split())

#: Names such as ``has-sidebar`` and ``nav-open`` tell a state of the page, not what the container is.
STATE_FIRST = frozenset("has no with without hide show".split())
STATE_LAST = frozenset("open opened closed collapsed expanded visible hidden active enabled disabled".split())

#: Blocks of fewer words are undecided; blocks with a larger share of link characters are boilerplate.
SHORT_WORDS, LINK_SHARE = 10, 0.33
#: Share of function words that running text has at least.
FUNCTION_SHARE = 0.1
#: A named container with more than this share of the page's text, and less running text beside it
#: than this share of its own, is a wrapper.
WRAPPER_SHARE, BESIDE_SHARE = 0.5, 0.1
#: Function words by language.
FUNCTION_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he his are this at from or have an they which you were all "
          "her she there would their we him been has when who will no if so what can more its but do my your our them than then",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie "
          "nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man ich wir",
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec ou son aux cette ont "
          "mais sa comme elle nous été même ses leur être je vous on si tout fait ces d l qu n s c",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si sin sobre este ya "
          "entre cuando todo esta ser son dos también fue había era muy hasta desde está nos durante",
    "pt": "de a o que e do da em um para é com não uma os no se na por mais as dos como mas foi ao ele das tem à seu sua ou ser "
          "quando muito há nos já está eu também só pelo pela até isso ela entre era depois sem mesmo aos",
    "it": "di e il la che in a per un è del della non i le con si da una sono al dei nel come più anche lo gli alla ma o su ha "
          "delle dal se questo nella questa ai era essere dalla c l d suo loro tra degli",
    "nl": "de van het een en in is dat op te zijn voor met die niet aan er om ook als dan maar bij of uit door naar heeft hij ze "
          "wordt nog ik je we was over deze hun tot kan zo meer geen al",
    "sv": "och i att det som en på är av för med den till inte har de ett om var så vi men jag från man han kan hade när nu där eller",
    "da": "og i at det er en til af på for med den som der ikke de har et var om men vi han jeg fra kan så sig efter eller blev",
    "no": "og i det er på en som for av til at med ikke har de den et om var jeg vi men han fra så kan seg eller etter ble",
    "fi": "ja on ei se että oli hän mutta ovat kun joka myös niin kuin tai jos sen ole hänen vain en tämä mitä siitä sitä nyt",
    "pl": "w i na z się do nie to że jest o a jak po co za od przez dla ale tak przy czy był są tym oraz może jego ich tylko być",
    "cs": "a se v na je že to s z do o i ve pro si za by ale jsem po jako k tak co od jeho byl které který nebo jsou až při už",
    "hu": "a az és hogy nem is egy ez volt meg de csak el azt ha már mint még van vagy ki mert aki sem minden ezt után lesz",
    "ro": "și de în a la cu că o pe nu este un din mai care pentru ca se au fi sau dar prin lui sunt după cel ce le al ale",
    "tr": "ve bir bu da de için ile çok olarak daha gibi olan ne en o kadar sonra ama var her ise mi ya değil diye hem",
    "id": "yang dan di dari dengan untuk ini itu pada dalam tidak adalah ke akan juga oleh atau ada sebagai mereka saya bisa lebih",
    "vi": "và của là có các được cho không trong một với những người đã khi để này từ đến về như ra cũng tôi nhưng",
    "ru": "и в не на я что он с как это а по но из у за к от так же для вы бы все о она мы его был то было только или еще уже если "
          "их до когда при были они",
    "uk": "і в не на що з та до у як за це він від по а але для є я про його так був вона ми які із чи бути вже або",
    "bg": "на и да се в за от е не с че по си като са до но той това ще към има при или беше който те още само",
    "sr": "и у је на да се за од са не су а као који што би о то из али све није или до по",
    "el": "και το να του η της με που την από για τα είναι των σε ο οι στο θα τη στην τον τους δεν τις ένα μια ότι ή αυτό",
    "ar": "في من على أن إلى التي عن الذي مع هذا لا ما هذه كان بين كل أو قد و بعد ذلك لم كما إن هو هي ثم حتى",
    "fa": "و در به از که این را با است برای آن یک خود تا می بر بود شد نیز هم یا ما اما شده کرد",
    "he": "של את על לא הוא זה עם כי גם או היא אל אם מה כל יש היה אני אבל בין רק אך כמו הם זו",
    "hi": "के का में की है से को और पर ने यह एक कि हैं भी नहीं इस लिए था हो या वह तो कर थे जो ही",
    "zh": " ".join("的是不了在有我他这這个個们們来來为為和也就都而及与與或但从從到对對以之其被把让讓会會要能可没沒很还還着著过過地得你她它那于於所如"),
    "ja": " ".join("のにはをたがでとしてもないるれさからっまよりだす"),
    "ko": " ".join("이다는의에을를은가고하지도로한과와서으"),
}

# the last two alternatives are a tag that the page's end cuts off, and running text
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)(?:>|\Z)|[^<]+|<", re.DOTALL)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_CLASS = re.compile(r"\bclass\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
#: Containers that can be a comment, and what signs one: a time, a date, an age or a link to reply.
COMMENT_TAGS = frozenset("li article div section dd".split())
_SIGNED = re.compile(r"\b(?:reply|report|permalink|antworten|r[eé]pondre|responder)\b|\b\d{1,2}[:.]\d{2}\b|\b\d{4}-\d\d-\d\d\b"
                     r"|\b\d+ (?:second|minute|hour|day|week|month|year)s? ago\b"
                     r"|\b\d{1,2}\.? (?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?,? \d{4}\b"
                     r"|\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.? \d{1,2},? \d{4}\b", re.IGNORECASE)
_SPACE = re.compile(r"\s+")
# letters and the marks of scripts that write vowels as such
_WORD = re.compile(r"[\w\u0300-\u036f\u0591-\u05c7\u064b-\u065f\u0900-\u0dff\u0e00-\u0eff]+")
_CJK = re.compile(r"[\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uac00-\ud7af\uf900-\ufaff]")
#: What the lists cover: digits, Latin, Greek, Cyrillic, Hebrew, Arabic and Devanagari words.
_LISTED = re.compile(r"[0-9a-z\u00c0-\u052f\u0590-\u06ff\u0900-\u097f\u1e00-\u1fff]")
_LANGUAGES: dict[str, list[str]] = {}
for _language, _list in FUNCTION_WORDS.items():
    for _word in _list.split():
        _LANGUAGES.setdefault(_word, []).append(_language)


@dataclass
class Block:
    text: str
    link_chars: int
    fixed: bool  # inside a container that is boilerplate whatever it holds
    named: tuple[int, ...]  # the other boilerplate containers around it
    article: int  # the article or main around it, 0 for none
    heading: bool
    container: int
    around: tuple[int, ...] = ()  # all containers, the outermost first
    length: float = 0  # in words
    function_share: float | None = None  # None: no list covers it
    boilerplate: bool = False
    label: str = ""
    how: str = "rule"  # what decided it: container, rule or neighbours


def _state(words: list[str]) -> bool:
    return len(words) > 1 and (words[0] in STATE_FIRST or words[-1] in STATE_LAST)


def _names_boilerplate(attributes: str) -> bool:
    for m in _NAMES.finditer(attributes):
        value = next(x for x in m.groups() if x is not None)
        names = [re.findall(r"[a-z]+|[0-9]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower()) for name in value.split()]
        words = [w for name in names if not _state(name) for w in name]
        found = BOILERPLATE_WORDS & set(words)
        if found == {"header"} and ARTICLE_WORDS & set(words):  # the article's own heading
            continue
        if found:
            return True
    return False


@dataclass
class _Open:
    tag: str
    boilerplate: bool
    fixed: bool
    fresh: bool  # an article that starts afresh inside other containers
    number: int
    like: str  # tag and class


def blocks(page: str) -> tuple[list[Block], dict[int, tuple[int, str]]]:
    """The page's blocks in order, without empty ones, and its containers: parent, tag and class."""
    out: list[Block] = []
    containers: dict[int, tuple[int, str]] = {}
    stack: list[_Open] = []
    text: list[str] = []
    count, links, link_chars = 0, 0, 0
    lower = ""

    def flush() -> None:
        nonlocal link_chars
        plain = _SPACE.sub(" ", entities.unescape("".join(text))).strip()
        if plain:
            tags = [o.tag for o in stack]
            within = stack[max((i for i, o in enumerate(stack) if o.fresh), default=0):]
            out.append(Block(plain, min(link_chars, len(plain)), any(o.fixed for o in stack),
                             tuple(o.number for o in within if o.boilerplate and not o.fixed),
                             next((o.number for o in stack if o.tag in ARTICLE_TAGS), 0), any(t in HEADING_TAGS for t in tags),
                             next((o.number for o in reversed(stack) if o.tag not in ("p", *HEADING_TAGS)), 0),
                             tuple(o.number for o in stack)))
        text.clear()
        link_chars = 0

    at = 0
    while m := _TOKEN.match(page, at):
        at = m.end()
        token = m[0]
        if token[0] != "<" or len(token) == 1:
            text.append(token)
            if links:
                link_chars += len(token.strip())
            continue
        close, tag, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not tag:  # a comment or a declaration
            continue
        tag = tag.lower()
        if not close and tag in RAW_TAGS and not attributes.endswith("/"):
            lower = lower or page.lower()
            end = lower.find(f"</{tag}", at)
            at = len(page) if end < 0 else (page.find(">", end) + 1 or len(page))
            if tag in BLOCK_TAGS:
                flush()
            continue
        if tag == "a":
            links = 0 if close else 1
            continue
        if tag not in BLOCK_TAGS:
            continue
        flush()
        links = 0
        if close:
            if any(o.tag == tag for o in stack):
                while stack.pop().tag != tag:
                    pass
        elif tag in BLOCK_TAGS and tag not in VOID_TAGS:
            if tag in ("p", *HEADING_TAGS, "div", "section", "ul", "ol", "table") and stack and stack[-1].tag == "p":
                stack.pop()  # a paragraph ends where the next block begins
            elif tag in ("li", "dt", "dd", "td", "th", "tr", "option") and stack and stack[-1].tag == tag:
                stack.pop()
            count += 1
            page_header = tag == "header" and not any(o.tag in ARTICLE_TAGS for o in stack)
            own = tag in BOILERPLATE_TAGS or page_header or (
                tag not in ("html", "body", "article", "main") and _names_boilerplate(attributes))
            fresh = (tag in ARTICLE_TAGS and not _names_boilerplate(attributes)
                     and not any(o.tag == "article" for o in stack))
            kind = _CLASS.search(attributes)
            like = f"{tag} {' '.join(sorted(next(x for x in kind.groups() if x is not None).split())) if kind else ''}"
            containers[count] = (stack[-1].number if stack else 0, like)
            stack.append(_Open(tag, own, own and tag in FIXED_TAGS, fresh, count, like))
    flush()
    return out, containers


def _comments(found: list[Block], containers: dict[int, tuple[int, str]]) -> set[int]:
    """Containers that are reader comments by their structure."""
    inside: dict[int, list[Block]] = {}
    for b in found:
        for number in b.around:
            inside.setdefault(number, []).append(b)
    siblings: dict[tuple[int, str], list[int]] = {}
    for number in inside:
        siblings.setdefault(containers[number], []).append(number)
    out: set[int] = set()
    for (_, like), numbers in siblings.items():
        if len(numbers) < 2 or like.split(" ")[0] not in COMMENT_TAGS:
            continue
        signed = [n for n in numbers if any(b.length < SHORT_WORDS and _SIGNED.search(b.text) for b in inside[n])
                  and any(b.length >= SHORT_WORDS for b in inside[n]) and not any(b.heading for b in inside[n])]
        if len(signed) * 3 >= len(numbers) * 2:
            out.update(numbers)
    return out


def _measure(block: Block) -> None:
    """The block's length in words (two characters of Chinese, Japanese or Korean) and its density of function words."""
    characters = _CJK.findall(block.text)
    words = _WORD.findall((_CJK.sub(" ", block.text) if characters else block.text).lower())
    block.length = len(words) + len(characters) / 2
    listed = characters + [w for w in words if _LISTED.match(w)]
    if len(listed) * 2 <= len(words) + len(characters):
        return
    found: dict[str, int] = {}
    for w in listed:
        for language in _LANGUAGES.get(w, ()):
            found[language] = found.get(language, 0) + 1
    block.function_share = max(found.values(), default=0) / len(listed)


def _first_pass(block: Block, covered: bool) -> str:
    """``covered``: the lists have the page's language."""
    if block.boilerplate:
        return "out"
    against = "" if block.article else "out"
    if block.link_chars > LINK_SHARE * len(block.text):
        return against
    if block.heading or block.length < SHORT_WORDS or block.function_share is None:
        return ""
    if block.function_share >= FUNCTION_SHARE:
        return "in"
    return against if covered else ""


def _wrappers(found: list[Block], covered: bool) -> set[int]:
    """Containers with a boilerplate name that hold the page's text."""
    open_ones = [b for b in found if not b.fixed]
    size = sum(len(b.text) for b in open_ones)
    own: dict[int, int] = {}
    for b in open_ones:
        for number in b.named:
            own[number] = own.get(number, 0) + len(b.text)
    wrappers: set[int] = set()
    for number in sorted(n for n, chars in own.items() if chars > WRAPPER_SHARE * size):  # outer ones first
        beside = sum(len(b.text) for b in open_ones
                     if number not in b.named and wrappers.issuperset(b.named) and (b.article or _first_pass(b, covered) == "in"))
        if beside < BESIDE_SHARE * own[number]:
            wrappers.add(number)
    return wrappers


def _nearest(labels: list[str]) -> tuple[list[int], list[int]]:
    """The place of the decided label at or before, and at or after, each place (-1: none)."""
    before, after = [], [-1] * len(labels)
    last = -1
    for i, label in enumerate(labels):
        last = i if label else last
        before.append(last)
    last = -1
    for i in range(len(labels) - 1, -1, -1):
        last = i if labels[i] else last
        after[i] = last
    return before, after


def _second_pass(blocks_: list[Block], nothing: str) -> None:
    """Gives the undecided ones of consecutive blocks their neighbours' label, or ``nothing`` if none is decided."""
    decided = [b.label for b in blocks_]
    before, after = _nearest(decided)
    for i, b in enumerate(blocks_):
        if b.label:
            continue
        b.how = "neighbours"
        left, right = before[i], after[i]
        if left < 0 or right < 0:
            b.label = decided[max(left, right)] if max(left, right) >= 0 else nothing
        elif decided[left] == decided[right] or b.heading:
            b.label = decided[right]
        elif (blocks_[left].container == b.container) != (blocks_[right].container == b.container):
            b.label = decided[left if blocks_[left].container == b.container else right]
        else:
            b.label = decided[left if i - left <= right - i else right]


def main_blocks(page: str) -> list[str]:
    """Texts of the blocks that belong to the article."""
    return [b.text for b in labelled_blocks(page) if b.label == "in"]


def labelled_blocks(page: str) -> list[Block]:
    """All blocks of a page with their labels, and what decided them."""
    found, containers = blocks(page)
    for b in found:
        _measure(b)
    comments = _comments(found, containers)
    covered = any((b.function_share or 0) >= FUNCTION_SHARE and b.length >= SHORT_WORDS for b in found)
    wrappers = _wrappers(found, covered)
    for b in found:
        b.boilerplate = b.fixed or not wrappers.issuperset(b.named) or not comments.isdisjoint(b.around)
        b.label = _first_pass(b, covered)
        b.how = "container" if b.boilerplate else "rule"
    # blocks in boilerplate containers say nothing about the text beside them
    open_ones = [b for b in found if not b.boilerplate]
    for article in dict.fromkeys(b.article for b in open_ones if b.article):
        _second_pass([b for b in open_ones if b.article == article], "in")
    _second_pass(open_ones, "in")
    return found


def main_text(df: DataFrame, html: str = "html", text: str = "main_text") -> DataFrame:
    """``df`` with the main text of each page (a column of that name is replaced) instead of its markup."""
    from pyspark.sql.types import StringType, StructField, StructType

    kept = df.drop(*{text} - {html})
    schema = StructType([f for f in kept.schema.fields if f.name != html] + [StructField(text, StringType())])
    kept = kept.withColumn(html, F.col(html).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages = batch.column(batch.schema.get_field_index(html))
            for at in range(0, batch.num_rows, 256):
                texts = ["\n".join(main_blocks(p.as_py() or "")) for p in pages.slice(at, 256)]
                others = [n for n in batch.schema.names if n != html]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(batch.schema.get_field_index(n)).slice(at, 256) for n in others] + [pa.array(texts, pa.string())],
                    names=[*others, text])

    return kept.mapInArrow(run, schema)
