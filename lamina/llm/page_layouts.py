"""Labelled training pages: layouts drawn by rule, filled with invented words.

The given pages carry no labels, so the labeller learns from pages whose parts are known. Each main block
starts with ``MARK``; taking the mark away gives the page, its places the labels.
"""

from __future__ import annotations

import random
from collections.abc import Callable

MARK = "\ue000"
# Class words as sites use them, by the part of the page they name, and words such parts hold.
NAMES = {
    "main": "article post content entry story body main text page single hentry blog prose news markdown detail",
    "nav": "nav menu navigation navbar links top bar primary tabs breadcrumb breadcrumbs crumbs pagination pager skip toc",
    "header": "header masthead banner brand logo site title top head hero",
    "footer": "footer bottom site legal copyright colophon foot credits imprint",
    "aside": "sidebar aside widget side rail related recommended popular trending more teaser secondary promo recirc",
    "notice": "cookie consent notice alert banner gdpr popup modal overlay message privacy warning disclaimer toast paywall",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner dfp adsense commercial partner",
    "form": "form newsletter subscribe signup search login register contact subscription field",
    "comments": "comments comment discussion replies respond thread responses feedback disqus reviews",
    "share": "share social sharing buttons follow tools actions like",
    "plain": "wrap wrapper container row col inner outer section box block grid layout grp unit module el panel clearfix",
}
WORDS = {
    "nav": "home about contact news world sport business culture blog archive shop products services help search login "
    "next previous page first last back forward start kontakt accueil inicio über nosotros seite suite más",
    "footer": "© copyright all rights reserved privacy policy terms imprint contact cookies sitemap impressum datenschutz mentions légales aviso legal",
    "notice": "we use cookies accept all this site uses to improve your experience agree settings by continuing you consent javascript enable please",
    "ad": "sponsored advertisement buy now offer sale discount % off limited free shipping deal today anzeige publicité publicidad",
    "form": "subscribe your email address name send submit search sign up newsletter password remember me required field",
    "comments": "comments reply said says likes report posted ago hours minutes yesterday leave a comment great thanks",
    "share": "share tweet facebook email print pin whatsapp save follow us link copy",
    "aside": "related popular most read recommended also tags categories recent posts archive trending more",
}
TONGUES = ("th er on an re he in ed nd ha at en es of or nt ea ti", "der ie sch en ein ung ich ge ver be ä ö ü ß lich", "que le es ent re on eau é è ou ç ai tion", "os a ción de que el ñ á í es ar para mos", "ka ri to na shi mu ra 漢 字 の は")


class Layout:
    """One page drawn from a seed."""

    def __init__(self, seed: int):
        self.draw = random.Random(seed)
        self.sounds = self.draw.choice(TONGUES).split()
        self.tags = self.draw.random() < 0.6
        self.loud = self.draw.random() < 0.4

    def chance(self, share: float) -> bool:
        return self.draw.random() < share

    def word(self) -> str:
        return "".join(self.draw.choices(self.sounds, k=self.draw.choice((1, 1, 2, 2, 3, 4)))) + self.draw.choice(["", "", "", "", ",", "###", "&amp;"] if self.chance(0.1) else [""])

    def prose(self, most: int) -> str:
        """A few sentences, now and then a single word; some words are emphasised or linked."""
        size = max(1, int(most ** self.draw.random()))
        words = [self.word() for _ in range(size)]
        words[0] = words[0].capitalize()
        if self.chance(0.1):
            # Articles too hold bars, capitals and other oddities; only their place tells them from menus.
            between, noise = self.draw.choice((" | ", " ", " - ", " / ", "  ")), self.draw.choice(("", "", "###", "!!", "%%%", "***"))
            return between.join(w.upper() + noise if self.loud else w + noise for w in words)
        for i in range(size):
            if self.chance(0.02):
                tag = self.draw.choice(["b", "i", "em", "strong", "span", "code", 'a href="/x"'])
                words[i] = f"<{tag}>{words[i]}</{tag.split()[0]}>"
            if self.chance(0.08):
                words[i] += self.draw.choice([".", ".", "?", ":", "!"])
        return " ".join(words) + self.draw.choice([".", ".", ".", "", "!"])

    def stock(self, part: str, most: int) -> str:
        """Words of a part's own stock, mixed with prose: sites in any tongue fill these parts too."""
        listed = WORDS[part].split()
        share = self.draw.choice((0.0, 0.3, 1.0))
        words = [self.draw.choice(listed) if self.chance(share) else self.word() for _ in range(self.draw.randint(1, most))]
        return " ".join(words)

    def attributes(self, part: str, tag: str) -> str:
        """class or id words of the part; parts without a telling tag always have some."""
        names = self.draw.sample(NAMES[part].split(), self.draw.randint(1, 2))
        if self.chance(0.3):
            names.append(self.draw.choice(NAMES["plain"].split()))
        text = self.draw.choice([" ", "-", "_"]).join(names)
        telling = tag in ("nav", "header", "footer", "aside", "form", "article", "main")
        if telling and self.chance(0.6):
            return ""
        return f' {self.draw.choice(["class", "class", "id"])}="{text}"' if part != "plain" or self.chance(0.7) else ""

    def box(self, part: str, tags: str, inside: str) -> str:
        choices = tags.split()
        tag = choices[0] if self.tags else self.draw.choice(choices)
        return f"<{tag}{self.attributes(part, tag)}>{inside}</{tag}>"

    def wrapped(self, inside: str) -> str:
        for _ in range(self.draw.choice((0, 0, 1, 2))):
            inside = self.box("plain", "div section", inside)
        return inside

    def links(self, part: str, most: int) -> str:
        items = [f'<a href="/{i}">{self.stock(part, 4)}</a>' for i in range(self.draw.randint(2, most))]
        return self.draw.choice([lambda: "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>", lambda: " | ".join(items), lambda: "".join(f"<div>{i}</div>" for i in items), lambda: " ".join(items)])()

    def navigation(self) -> str:
        return self.wrapped(self.box("nav", "nav div ul", self.links("nav", 8)))

    def top(self) -> str:
        inner = [f"<div>{self.stock('nav', 3)}</div>", f"<p>{self.prose(12)}</p>", self.navigation(), self.form()]
        return self.box("header", "header div", "".join(self.draw.sample(inner, self.draw.randint(1, 3))))

    def advert(self) -> str:
        return self.box("ad", "div div aside section ins", self.draw.choice([self.prose(15), f"<p>{self.stock('ad', 12)}</p>", f'<a href="/">{self.stock("ad", 6)}</a>', f"<h3>{self.stock('ad', 3)}</h3><p>{self.prose(25)}</p>"]))

    def notice(self) -> str:
        return self.box("notice", "div div section dialog aside", f"<p>{self.stock('notice', 30)}</p>" * self.draw.randint(1, 2) + (f"<button>{self.stock('notice', 2)}</button>" if self.chance(0.6) else ""))

    def form(self) -> str:
        inner = f"<label>{self.stock('form', 3)}</label><input name=q><button>{self.stock('form', 2)}</button>"
        if self.chance(0.5):
            inner = f"<h3>{self.stock('form', 4)}</h3><p>{self.prose(25)}</p>" + inner
        if self.chance(0.3):
            inner += "<select>" + "".join(f"<option>{self.stock('form', 2)}" for _ in range(3)) + "</select>"
        form = f"<form{self.attributes('form', 'form')}>{inner}</form>"
        return self.box("form", "div section", form) if self.chance(0.4) else form

    def sidebar(self) -> str:
        inner = [self.box("aside", "section div", f"<h3>{self.stock('aside', 3)}</h3>" + self.draw.choice([self.links("aside", 6), f"<p>{self.prose(40)}</p>" * 2])) for _ in range(self.draw.randint(1, 3))]
        return self.box("aside", "aside div", "".join(inner))

    def comments(self) -> str:
        item = self.draw.choice(["li", "div", "article", "section"])
        body = "".join(
            f"<{item}{self.attributes('comments', item)}><div>{self.word()} {self.stock('comments', 3)}</div>"
            + "".join(f"<p>{self.prose(60)}</p>" for _ in range(self.draw.randint(1, 3)))
            + (f'<a href="/r">{self.stock("comments", 2)}</a>' if self.chance(0.5) else "") + f"</{item}>"
            for _ in range(self.draw.randint(1, 5))
        )
        head = f"<h2>{self.stock('comments', 3)}</h2>" if self.chance(0.7) else ""
        return self.box("comments", "section div aside", head + (f"<ol>{body}</ol>" if item == "li" else body) + (self.form() if self.chance(0.4) else ""))

    def footer(self) -> str:
        parts = [self.links("footer", 6), f"<p>{self.stock('footer', 12)}</p>", f"&copy; {self.word()}.example &middot; {self.prose(12)}", f"<div>{self.prose(30)}</div>"]
        return self.box("footer", "footer div", "".join(self.draw.sample(parts, self.draw.randint(1, 3))))

    def share(self) -> str:
        return self.box("share", "div ul section", self.links("share", 5))

    def article(self, title: str) -> str:
        """The main blocks, with things between them that do not belong there."""
        mark = MARK
        out = [f"<h1>{mark}{title}</h1>"] if self.chance(0.85) else []
        if self.chance(0.2):
            out = [f"<header>{''.join(out)}</header>"]
        between: tuple[Callable[[], str], ...] = (self.advert, self.share, self.form, self.sidebar, lambda: f"<script>var t = '</p>{self.word()}';</script>", lambda: f"<!-- {self.word()} -->")
        style = self.draw.choice(["p", "p", "p", "p", "div", "loose"])
        for _ in range(self.draw.randint(1, 14)):
            kind, text = self.draw.random(), self.prose(70)
            if kind < 0.68:
                if style == "loose":
                    out.append(f"<div>{mark}{text}</div>" if self.chance(0.5) else f"<p>{mark}{text}")
                elif self.chance(0.15):
                    out.append(f"<{style}>{mark}<b>{text}<br>")
                    if style == "div":
                        out.append("</b></div>")
                else:
                    out.append(f"<{style}>{mark}{text}</{style}>")
            elif kind < 0.76:
                level = self.draw.choice("2234")
                out.append(f"<h{level}>{mark}{self.prose(8)}</h{level}>")
            elif kind < 0.84:
                tag = self.draw.choice(["ul", "ol"])
                out.append(f"<{tag}>" + "".join(f"<li>{mark}{self.prose(20)}</li>" for _ in range(self.draw.randint(1, 5))) + f"</{tag}>")
            elif kind < 0.88:
                out.append(f"<blockquote><p>{mark}{text}</p></blockquote>")
            elif kind < 0.9:
                out.append(f"<pre>{mark}{text}</pre>")
            elif kind < 0.92:
                out.append(f'<figure><img src="x.png"><figcaption>{mark}{self.prose(15)}</figcaption></figure>')
            elif kind < 0.94:
                out.append("<table>" + "".join("<tr>" + "".join(f"<td>{mark}{self.prose(4)}</td>" for _ in range(3)) + "</tr>" for _ in range(2)) + "</table>")
            else:
                out.append(self.draw.choice(between)())
        tag = self.draw.choice(["article", "main", "section", "div"]) if not self.tags else "article"
        names = self.attributes("main", tag)
        if tag in ("div", "section") and self.chance(0.15):
            names = ""
        return self.wrapped(f"<{tag}{names}>{''.join(out)}</{tag}>")

    def html(self) -> str:
        draw = self.draw
        title = self.prose(12).replace("<", "&lt;") if self.chance(0.3) else " ".join(self.word() for _ in range(draw.randint(1, 10)))
        head = f'<head><meta charset="utf-8"><title>{title}</title><style>p{{margin:0}}</style><script>var t="</p>";</script></head>'
        before = [part() for part in (self.notice, self.top, self.navigation, self.advert, self.navigation, self.form) if self.chance(0.45)]
        after = [part() for part in (self.share, self.comments, self.sidebar, self.advert, self.form, self.notice, self.navigation) if self.chance(0.35)]
        beside = [self.sidebar()] if self.chance(0.2) else []
        body = "".join([*before, *beside, self.article(title), *after, *([self.footer()] if self.chance(0.8) else [])])
        names = f' class="{draw.choice(NAMES["plain"].split())} {draw.choice(NAMES["main"].split())}"' if self.chance(0.2) else ""
        return f'<!DOCTYPE html><html lang="en">{head}<body{names}>{self.wrapped(body)}</body></html>'
