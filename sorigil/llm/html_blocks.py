"""Visible blocks of an HTML page: a small tolerant reader of tags (no tree is built)."""

from __future__ import annotations

import html as entities
import re

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+|[^>]*)>|<[!?][^>]*>", re.S)
ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
WORD = re.compile(r"[a-z0-9]+")
SPACE = re.compile(r"[\x20\x09-\x0D]+")

# Elements by their part in a page.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
WITHIN = frozenset("script style template noscript".split())  # may stand within a sentence
DROPPED = frozenset("head nav aside footer form button select option svg canvas object audio video dialog menu fieldset".split()) | RAW
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rb rp rt s samp small span strike strong sub sup "
    "time tt u var wbr math mi mn mo ms mtext mrow mfrac msqrt mroot msup msub msubsup mover munder munderover mstyle mpadded mspace "
    "semantics annotation".split()
)
ARTICLE, MAIN = "article", "main"
CHROME_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert popup modal "
    "overlay newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments respond disqus share sharing "
    "social related recommended widget login signup pagination pager toolbar copyright".split()
)
CHROME_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
ABSENT = frozenset("with without has no is".split())  # with-sidebar: speaks of the page, is no sidebar
PLACES = frozenset(
    "area articles bar block body bottom box button buttons container content form footer header inner items left links list main outer panel post posts "
    "right section slot top unit wrap wrapper".split()
)
WRAPPER = re.compile(r"<(?:article|main)\b|\b__VIEWSTATE\b", re.I)  # what a form that holds a whole page has in it
KINDS = ("article", "main", "other", "chrome")


def names_chrome(value: str, whole: bool) -> bool:
    """Whether a class or id list has a name with a chrome word; ``whole``: and no words but those and places."""
    for token in value.split():
        words = WORD.findall(token)
        if words and words[0] not in ABSENT and not CHROME_WORDS.isdisjoint(words):
            if not whole or all(w in CHROME_WORDS or w in PLACES or w.isdigit() for w in words):
                return True
    return False


def is_chrome(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element is no part of an article by its name, class, id or role. Inside an article an id is often
    made of a heading (``related-work``), so there all its words have to speak of chrome."""
    if name in DROPPED or (name == "header" and not inside):
        return True
    if not attributes or name in ("html", "body", MAIN):
        return False
    for m in ATTR.finditer(attributes):
        value = (m[2] or m[3] or m[4] or "").lower()
        if m[1].lower() == "role":
            if value in CHROME_ROLES:
                return True
        elif names_chrome(value, inside and m[1].lower() == "id"):
            return True
    return False


def end_of(page: str, name: str, at: int) -> int:
    """Where the next end tag of that name is, -1 if there is none."""
    found = page.find("</" + name, at)
    if found >= 0:
        return found
    m = re.compile("</" + re.escape(name), re.I | re.A).search(page, at)
    return m.start() if m else -1


def blocks(page: str | None) -> list[tuple[int, str]]:
    """(kind, text) of the page's blocks in order: white space made one space, references decoded, trimmed, none empty."""
    if not page:
        return []
    out: list[tuple[int, str]] = []
    parts: list[str] = []
    at, n = 0, len(page)
    articles = mains = 0
    last = page.rfind(">")  # behind it there is no tag, so none is looked for
    endless: set[str] = set()  # names without an end tag from some place on
    wrapped = form_end = -1  # where the next sign of a whole page and the next end of a form are; n: nowhere
    skip, depth = "", 0  # the chrome element that is open and how often its name is open within it; 0: it has no end

    def kind() -> int:
        return 3 if skip else 0 if articles else 1 if mains else 2

    def close() -> None:
        if parts:
            text = "".join(parts)
            parts.clear()
            text = SPACE.sub(" ", entities.unescape(text) if "&" in text else text).strip(" ")
            if text:
                out.append((kind(), text))

    def has_end(name: str, at: int) -> bool:
        if name not in endless and end_of(page, name, at) < 0:
            endless.add(name)
        return name not in endless

    def holds_page(at: int) -> bool:
        """Whether the form that begins here is about the whole page."""
        nonlocal wrapped, form_end
        if wrapped < at:
            wrapped = m.start() if (m := WRAPPER.search(page, at)) else n
        if form_end < at:
            found = end_of(page, "form", at)
            form_end = found if found >= 0 else n
        return wrapped < form_end

    while at < n:
        tag = TAG.search(page, at) if at <= last else None
        if tag is None:
            open_comment = page.find("<!--", at)
            parts.append(page[at:] if open_comment < 0 else page[at:open_comment])
            break
        if tag.start() > at:
            parts.append(page[at : tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        name, ending = tag[2].lower(), bool(tag[1])
        if not ending and name in RAW:
            if name not in WITHIN:
                close()
            end = end_of(page, name, at)
            if end < 0:
                break
            at = page.find(">", end) + 1 or n
            continue
        if name in INLINE and not skip:
            if name == "br":
                parts.append(" ")
            if name in VOID or ending or not (tag[3] and is_chrome(name, tag[3], articles + mains > 0)):
                continue
        elif name in VOID:
            if name == "hr":
                close()
            continue
        if name not in INLINE:
            close()
        if ending:
            if skip:
                if name == skip:
                    depth -= 1
                    if not depth:
                        close()
                        skip = ""
                elif name in (ARTICLE, "body", "html") and (name != ARTICLE or articles):
                    skip, depth = "", 0  # its end is missing
            if not skip and name == ARTICLE:
                articles = max(0, articles - 1)
            elif not skip and name == MAIN:
                mains = max(0, mains - 1)
        elif skip and (depth or name not in (ARTICLE, MAIN)):
            depth += name == skip and depth > 0
        elif is_chrome(name, tag[3], articles + mains > 0) and not (name == "form" and holds_page(at)):
            if not tag[3].endswith("/"):
                close()
                skip, depth = name, int(has_end(name, at))
        elif name in (ARTICLE, MAIN):
            skip = ""
            articles += name == ARTICLE
            mains += name == MAIN
    close()
    return out
