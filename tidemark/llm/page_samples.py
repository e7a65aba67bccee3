"""Labelled pages to train main-text extraction on, composed from common layouts.

Pages carry their labels in the attribute ``data-main`` (see ``dom``). Layouts differ in the elements,
class names and order of their parts; some have neither telling elements nor telling names, so that the
text has to tell. Words are made of syllables, phrases are the usual ones of menus, notices and footers.
"""

from __future__ import annotations

import random

_SYLLABLES = "an ar be con da der el en er es fa ge ha in is ka la le ma men mo ne no on or pe ra re ri sa se so ta te ti to un ve vi wa".split()
_FUNCTION = "the of and to in a is that it for der die und in den von la le et les des el de que y en un est das".split()
#: Usual phrases of the parts around a page's main text, in four languages.
PHRASES = {
    "notice": "We use cookies to improve your experience.|This site uses cookies. Accept all cookies|Wir verwenden Cookies.|Nous utilisons des cookies.|Utilizamos cookies propias y de terceros.|By continuing you agree to our privacy policy.",
    "menu": "Home|About us|Contact|News|Products|Log in|Sign up|Search|Start|Impressum|Kontakt|Accueil|Inicio|Shop|Blog|Help|Menu|Archive|Sitemap",
    "share": "Share this|Tweet|Share on Facebook|Print|E-mail|Teilen|Partager|Compartir|Follow us",
    "related": "Related articles|You may also like|Most read|Popular posts|Read more|Trending now|Recommended for you|Mehr zum Thema|Lire aussi|Te puede interesar|Categories|Tags|Archives",
    "comments": "Comments|3 comments|Leave a reply|Post a comment|Reply|Report|Kommentare|Commentaires|Comentarios|Antworten",
    "form": "Subscribe to our newsletter|Your e-mail|Name|Submit|Send|Password|Forgot your password?|Register now|Abonnieren|Absenden|S'abonner|Enviar",
    "ad": "Advertisement|Sponsored|Anzeige|Publicité|Publicidad|Buy now and save 20%|Limited offer!|Shop now",
    "footer": "All rights reserved.|Privacy policy|Terms of use|Datenschutz|Mentions légales|Aviso legal|Back to top|Powered by",
}
_PHRASES = {k: v.split("|") for k, v in PHRASES.items()}


class _Page:
    def __init__(self, rng: random.Random):
        self.rng, self.writing = rng, False
        self.plain_names = rng.random() < 0.3  # no telling class names
        self.semantic = rng.random() < 0.5  # telling elements
        self.junk = rng.choice([" | ", "### ", "*** ", " & ", " / ", " \u00b7 "]) if rng.random() < 0.2 else ""  # stands between the words of the main text

    def word(self) -> str:
        r = self.rng
        return r.choice(_FUNCTION) if r.random() < 0.4 else "".join(r.choice(_SYLLABLES) for _ in range(r.randint(1, 4)))

    def words(self, n: int) -> str:
        return " ".join(self.word() for _ in range(n))

    def sentence(self, low: int = 4, high: int = 22) -> str:
        r = self.rng
        ws = [self.word() + ("," if r.random() < 0.08 else "") for _ in range(r.randint(low, high))]
        return " ".join(ws).capitalize().rstrip(",") + r.choices([".", "!", "?"], [0.9, 0.05, 0.05])[0]

    def prose(self, low: int = 1, high: int = 7) -> str:
        text = " ".join(self.sentence(1 if self.rng.random() < 0.15 else 4) for _ in range(self.rng.randint(low, high)))
        if self.writing and self.junk:
            text = text.replace(" ", self.junk)
            text = text.upper() if self.rng.random() < 0.2 else text
        return text

    def phrase(self, kind: str) -> str:
        return self.rng.choice(_PHRASES[kind])

    def name(self, *names: str) -> str:
        """A class or id attribute, or none."""
        r = self.rng
        if self.plain_names or r.random() < 0.15:
            return r.choice(["", f' class="{"".join(r.choice(_SYLLABLES) for _ in range(2))}{r.randint(1, 99)}"'])
        return f' {r.choice(["class", "class", "id"])}="{r.choice(names)}"'

    def tag(self, telling: str, plain: str = "div") -> str:
        return telling if self.semantic else plain

    def link(self, text: str) -> str:
        return f'<a href="/{self.rng.randint(1, 999)}">{text}</a>'

    def links(self, kind: str | None, low: int = 3, high: int = 9) -> list[str]:
        r = self.rng
        return [self.link(self.phrase(kind) if kind and r.random() < 0.6 else self.words(r.randint(1, 4))) for _ in range(r.randint(low, high))]

    def listed(self, items: list[str]) -> str:
        shape = self.rng.randrange(4)
        if shape < 2:
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        if shape == 2:
            return " | ".join(items)
        return "".join(f"<div>{i}</div>" for i in items)

    # parts around the main text

    def menu(self) -> str:
        t = self.tag("nav")
        return f'<{t}{self.name("menu", "nav", "navbar", "top-menu", "navigation")}>{self.listed(self.links("menu"))}</{t}>'

    def header(self) -> str:
        t, r = self.tag("header"), self.rng
        logo = r.choice([self.link(self.words(2)), f"<h1>{self.words(2)}</h1>", f"<p>{self.words(3)}</p>"])
        return f'<{t}{self.name("header", "masthead", "site-header", "banner", "logo")}>{logo}{self.menu() if r.random() < 0.6 else ""}</{t}>'

    def notice(self) -> str:
        inner = f"<p>{self.phrase('notice')} {self.sentence() if self.rng.random() < 0.4 else ''}</p>"
        return f'<div{self.name("cookie-notice", "cookie-banner", "consent", "notice", "alert", "gdpr popup")}>{inner}<button>{self.rng.choice(["OK", "Accept", "Close"])}</button></div>'

    def ad(self) -> str:
        text = self.rng.choice([self.phrase("ad"), self.prose(1, 3), f"{self.phrase('ad')} {self.sentence()}"])
        names = self.rng.choice(["ad", "ads", "advert", "sponsored", "promo", "ad-box banner"])
        return f'<!-- ad {self.rng.randint(0, 99)} --><div class="{names}">{text}</div>'

    def sidebar(self) -> str:
        t = self.tag("aside")
        parts = [f"<h3>{self.phrase('related')}</h3>{self.listed(self.links(None, 3, 8))}"]
        if self.rng.random() < 0.5:
            parts.append(f"<h4>{self.words(2)}</h4><p>{self.sentence(3, 9)} {self.link('more')}</p>")
        if self.rng.random() < 0.3:
            parts.append(self.form())
        return f'<{t}{self.name("sidebar", "side", "widget", "right-rail", "related")}>{"".join(parts)}</{t}>'

    def form(self) -> str:
        return (
            f'<form{self.name("newsletter", "search", "signup", "login-form")}><p>{self.phrase("form")}</p><label>{self.phrase("form")}</label>'
            f'<input type="text"><select><option>{self.word()}<option>{self.word()}</select><button>{self.phrase("form")}</button></form>'
        )

    def share(self) -> str:
        return f'<div{self.name("share", "social", "sharing-buttons", "share-bar")}>{self.listed([self.link(self.phrase("share")) for _ in range(3)])}</div>'

    def crumbs(self) -> str:
        return f'<div{self.name("breadcrumb", "breadcrumbs")}>{" &raquo; ".join(self.links("menu", 2, 4))}</div>'

    def comments(self) -> str:
        t, r = self.tag("section"), self.rng
        e = r.choice(["div", "li"])
        one = lambda: f'<{e}{self.name("comment", "reply")}><b>{self.words(2)}</b> <p>{self.prose(1, 3)}</p>{self.link(self.phrase("comments"))}</{e}>'
        heading = f"<h3>{self.phrase('comments')}</h3>"
        names = r.choice(["comments", "discussion", "reader-comments", "comment-list", "replies"])
        return f'<{t} class="{names}">{heading}{"".join(one() for _ in range(r.randint(1, 5)))}{self.form() if r.random() < 0.4 else ""}</{t}>'

    def footer(self) -> str:
        t, r = self.tag("footer"), self.rng
        lines = [f"&copy; {r.choice(['2024 ', '', '2019-2025 '])}{self.word()}.example.com &middot; {self.sentence(2, 8)}", f"&copy; {self.words(2)}. {self.phrase('footer')}", self.phrase("footer")]
        inner = r.choice(lines)
        if r.random() < 0.5:
            inner += self.listed(self.links("footer", 2, 5))
        return f'<{t}{self.name("footer", "site-footer", "bottom", "legal", "copyright")}>{inner}</{t}>'

    # main text

    def paragraph(self) -> str:
        r, k = self.rng, self.rng.random()
        text = self.prose()
        if r.random() < 0.15:
            at = text.find(" ") + 1
            text = text[:at] + self.link(self.words(2)) + " " + text[at:]
        if k < 0.62:
            return f"<p>{text}</p>"
        if k < 0.70:
            return f"<p>{text}"
        if k < 0.78:
            return f"<p><b>{self.sentence(1, 9)}<br><p>{text}</p>"
        if k < 0.83:
            return f"<h2>{self.words(r.randint(1, 7))}</h2><p>{text}</p>"
        if k < 0.87:
            return "<ul>" + "".join(f"<li>{self.sentence(2, 12)}" for _ in range(r.randint(2, 5))) + "</ul>"
        if k < 0.90:
            return f"<blockquote>{text}</blockquote>"
        if k < 0.92:
            return f"<pre>{self.words(8)}\n  {self.words(4)}</pre>"
        if k < 0.94:
            return "<table>" + "".join(f"<tr><td>{self.words(2)}</td><td>{r.randint(1, 999)}</td></tr>" for _ in range(3)) + "</table>"
        if k < 0.96:
            return f'<figure><img src="x.png"><figcaption>{self.sentence(3, 10)}</figcaption></figure>'
        return f"<p>{text}<br>{self.prose(1, 2)}</p>"

    def main(self) -> str:
        r = self.rng
        t = r.choice(["article", "article", "main"]) if self.semantic else r.choice(["div", "div", "td", "section"])
        names = self.name("article", "content", "post", "entry-content", "main-content", "story", "article-body")
        title = self.words(r.randint(2, 11)) if r.random() < 0.5 else self.sentence()[:60].rsplit(" ", 1)[0]
        self.writing = True
        body = [f"<h1>{title}</h1>"] if r.random() < 0.9 else []
        shape = r.random()
        n = r.choice([1, 2, 3, 4, 6, 8, 12])
        if shape < 0.85:
            body += [self.paragraph() for _ in range(n)]
        elif shape < 0.93:
            body += [f"<div>{self.prose(2, 6)}</div>" for _ in range(n)]
        else:
            body.append("<br><br>".join(self.prose(2, 6) for _ in range(n)))
        self.writing = False
        for part in (self.ad, self.share, self.form, self.sidebar):
            if r.random() < 0.08:
                body.insert(r.randint(1, len(body)) if body else 0, f'<div data-main="0">{part()}</div>')
        inner = "".join(body)
        if r.random() < 0.15:
            inner = f'{inner}<div data-main="0">{self.comments()}</div>'
        if t == "td":
            return f'<table><tr><td>{self.listed(self.links("menu"))}<td data-main="1"{names}>{inner}</table>'
        return f'<{t} data-main="1"{names}>{inner}</{t}>'

    def html(self) -> str:
        r = self.rng
        before = [p() for p, chance in ((self.notice, 0.25), (self.header, 0.4), (self.menu, 0.6), (self.crumbs, 0.2), (self.ad, 0.4), (self.sidebar, 0.2), (self.form, 0.08)) if r.random() < chance]
        after = [p() for p, chance in ((self.share, 0.2), (self.comments, 0.3), (self.sidebar, 0.3), (self.ad, 0.15), (self.form, 0.12), (self.footer, 0.75), (self.notice, 0.1)) if r.random() < chance]
        if r.random() < 0.2:
            r.shuffle(before)
        main = self.main() if r.random() < 0.97 else ""
        end = "</body></html>" if r.random() < 0.9 else ""
        head = f'<!DOCTYPE html><html lang="en"><head><meta charset="utf-8"><title>{self.words(5)}</title><style>p{{margin:0}}</style><script>var t="</p>";track(0);</script></head>'
        return f'{head}<body data-main="0">{"".join(before)}{main}{"".join(after)}{end}'


def labelled_pages(n: int, seed: int) -> list[str]:
    """``n`` labelled pages; the same ones for the same seed."""
    rng = random.Random(seed)
    return [_Page(rng).html() for _ in range(n)]
