"""Blocks with known labels to learn from: arrangements of the texts of real pages."""

from __future__ import annotations

import random
from collections.abc import Sequence

from claimwright.llm.html_blocks import Block, Element, Path

# Names that say what an element holds.
CONTENT_NAMES = (
    "content|post body|entry content|article body|story|article|post|main content|page text|text|"
    "blog post|news|body text|article content|single post|wiki content|description|recipe|review"
).split("|")
NOT_CONTENT_NAMES = {
    "nav": "menu|nav|navbar|navigation|breadcrumb|breadcrumbs|main menu|top nav|pagination|pager|"
    "toc links|tabs|site nav|toolbar|skip links|language switcher",
    "header": "header|masthead|site header|top|banner|page header|logo|branding|topbar|hero title",
    "footer": "footer|site footer|bottom|copyright|colophon|legal|foot|page footer|imprint",
    "aside": "sidebar|aside|widget|related|related posts|recommended|tags|share|social|author box|"
    "newsletter|side|right column|trending|popular|see also links|more stories|promo box|rail",
    "notice": "cookie|cookies|cookie banner|notice|consent|gdpr|alert|popup|modal|overlay|warning|"
    "message|announcement|paywall|privacy notice|cookie notice|info bar|toast",
    "advert": "ad|ads|advert|adverts|advertisement|sponsored|promo|ad slot|banner ad|sponsor|"
    "adsense|google ad|partner|commercial|outbrain|taboola",
    "form": "form|search|login|subscribe|signup|contact form|search box|register|search form|"
    "newsletter form|feedback|poll|survey",
    "comments": "comments|comment|comment list|replies|reply|responses|discussion|disqus|"
    "comment body|reader comments|user comment|thread|respond|comment text|feedback list",
}
TAGS = {
    "nav": ("nav", "div", "ul"),
    "header": ("header", "div"),
    "footer": ("footer", "div", "section"),
    "aside": ("aside", "div", "section"),
    "notice": ("div", "section", "aside"),
    "advert": ("div", "aside", "section", "ins"),
    "form": ("form", "form", "div"),
    "comments": ("section", "div", "ol"),
}
# Tags that say enough without a name.
PLAIN = ("nav", "header", "footer", "aside", "form")
STOCK = {
    "nav": "Home|About|Contact|Next|Previous|News|Sitemap|Archive|Skip to content|All topics",
    "header": "Welcome|The daily paper|Breaking news|Your trusted source",
    "footer": "© 2024 All rights reserved.|Privacy policy|Terms of use|Imprint|Powered by",
    "aside": "Related articles|Share this|Follow us|Read more|Most read|Tags|You may also like",
    "notice": "We use cookies to improve your experience.|Accept all|Manage settings|"
    "This site uses cookies.|Please enable JavaScript.|Your browser is out of date.",
    "advert": "Advertisement|Sponsored|Buy now|Save 50 % today|Click here|Limited offer",
    "form": "Search|Log in|Sign up|Subscribe to our newsletter|Your email|Password|Send|Name",
    "comments": "Leave a comment|Reply|3 comments|Posted by guest|says:|Report|Log in to reply",
}
WRAPPERS = "wrapper|page|container|site|row|col|inner|layout|grid|wrap|main|outer|app|root|center"
CONTENT_TAGS = ("p", "p", "p", "p", "p", "h2", "h3", "li", "blockquote", "div", "pre", "td", "figcaption")


class Arranger:
    """Pages made of given texts, each block with its label: 1 within the article."""

    def __init__(self, proses: Sequence[str], seed: int) -> None:
        self.proses, self.random = list(proses), random.Random(seed)

    def page(self) -> list[tuple[Block, int]]:
        pick = self.random
        self.made: list[tuple[Block, int]] = []
        outer = self._path(None, ("html", ()), ("body", ()))
        for _ in range(pick.choice((0, 0, 1, 2))):
            outer = self._path(outer, ("div", self._noisy(pick.choice(WRAPPERS.split("|")))))
        before = [kind for kind in ("header", "nav", "notice", "advert", "form", "aside") if pick.random() < 0.5]
        pick.shuffle(before)
        for kind in before:
            self._other(outer, kind)
        if pick.random() < 0.95:
            self._article(outer)
        after = [kind for kind in ("comments", "aside", "advert", "form", "nav", "notice") if pick.random() < 0.4]
        pick.shuffle(after)
        for kind in after:
            self._other(outer, kind)
        if pick.random() < 0.7:
            self._other(outer, "footer")
        return self.made

    def _path(self, parent: Path | None, *elements: Element) -> Path:
        for element in elements:
            parent = Path(element, parent)
        return parent

    def _noisy(self, names: str) -> tuple[str, ...]:
        """The words of a name, at times among words that say nothing."""
        words = names.split()
        if self.random.random() < 0.3:
            noise = "".join(self.random.choices("abcdefghijklmnoprstuvw", k=self.random.randint(1, 7)))
            words.insert(self.random.randint(0, len(words)), noise)
        if self.random.random() < 0.1:
            words.append(str(self.random.randint(0, 99)))
        return tuple(words)

    def _put(self, path: Path, text: str, label: int, linked: bool = False) -> None:
        text = " ".join(text.split())
        if text:
            self.made.append((Block(text, path, len(text) if linked else 0), label))

    def _prose(self) -> str:
        return self.random.choice(self.proses)

    def _words(self) -> str:
        words = self._prose().split()
        at = self.random.randrange(max(1, len(words) - 3))
        return " ".join(words[at : at + self.random.randint(1, 4)])

    def _article(self, outer: Path) -> None:
        pick = self.random
        way = pick.random()
        if way < 0.35:
            within = self._path(outer, ("article", ()))
        elif way < 0.45:
            within = self._path(outer, ("main", ()), ("article", ()))
        elif way < 0.55:
            within = self._path(outer, ("main", self._noisy("") if pick.random() < 0.5 else ()))
        elif way < 0.93:
            tag = pick.choice(("div", "div", "section", "td", "article"))
            within = self._path(outer, (tag, self._noisy(pick.choice(CONTENT_NAMES))))
        else:
            within = outer
        if pick.random() < 0.8:
            self._put(self._path(within, ("h1", ())), self._prose()[:80], 1)
        for _ in range(pick.choice((1, 2, 3, 5, 8, 13))):
            if pick.random() < 0.04:
                self._other(within, pick.choice(("advert", "aside", "form", "notice", "nav")))
            tag = pick.choice(CONTENT_TAGS)
            around = {"li": [("ul", ())], "td": [("table", ()), ("tr", ())], "figcaption": [("figure", ())]}
            path = self._path(within, *around.get(tag, []), (tag, ()))
            text = self._prose()
            short = pick.random() < 0.15 or tag in ("h2", "h3", "figcaption")
            self._put(path, " ".join(text.split()[: pick.randint(1, 6)]) if short else text, 1)
        if pick.random() < 0.15:
            self._other(within, pick.choice(("comments", "aside", "footer")))

    def _other(self, outer: Path, kind: str) -> None:
        pick = self.random
        tag = pick.choice(TAGS[kind])
        names = pick.choice(NOT_CONTENT_NAMES[kind].split("|"))
        plain = tag in PLAIN and pick.random() < 0.5
        within = self._path(outer, (tag, () if plain else self._noisy(names)))
        stock = STOCK[kind].split("|")
        for _ in range(pick.choice((1, 1, 2, 3, 6))):
            inner = pick.choice(([], [("p", ())], [("div", ())], [("ul", ()), ("li", ())], [("h3", ())]))
            if kind == "nav" and pick.random() < 0.8:
                inner = [("ul", ()), ("li", ())]
            if kind == "header" and pick.random() < 0.5:
                inner = [(pick.choice(("h1", "h1", "h2")), ())]
            path = self._path(within, *inner)
            if kind in ("comments", "notice", "advert", "aside", "footer", "header") and pick.random() < 0.6:
                text = self._prose()
                if kind != "comments" and pick.random() < 0.5:
                    text = " ".join(text.split()[: pick.randint(2, 15)])
                self._put(path, text, 0)
            elif pick.random() < 0.5:
                self._put(path, pick.choice(stock), 0, linked=kind == "nav")
            else:
                self._put(path, self._words(), 0, linked=kind in ("nav", "aside", "footer"))


def by_markup(block: Block) -> int:
    """The label of a block of a page whose own elements name its parts."""
    path, within = block.path, False
    while path is not None:
        tag, words = path.element
        if tag in PLAIN or any(set(words) & set(names.split("|")) for names in NOT_CONTENT_NAMES.values()):
            return 0
        within = within or tag in ("article", "main")
        path = path.parent
    return int(within)
