"""Main text of web pages by a recurrent block labeller.

A page becomes a sequence of leaf blocks. Each block is a vector: its hashed tag path (tags, class, id and role words
of its ancestors), its hashed words, and a few measures. A bidirectional LSTM in numpy reads the sequence both ways, so
that every block is labelled with the whole page as context. It is trained here, on pages that a grammar writes with
known article blocks: a fixed number of pages, ``TRAIN_PAGES``. Half of these pages have the usual names of containers; in the
other half containers have random names or there are none, so that words, links, length and neighbours must decide.
"""

from __future__ import annotations

import pickle
import random
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .html_blocks import Block, Element, blocks_of

PATH_DIMS, WORD_DIMS, MEASURES, HIDDEN = 512, 128, 11, 24
DIMS = PATH_DIMS + WORD_DIMS + MEASURES
TRAIN_PAGES = 4000


class _Slots(dict):
    """A token's place among ``dims``, by hash; remembers some tokens."""

    def __init__(self, dims: int):
        super().__init__()
        self.dims = dims

    def __missing__(self, token: str) -> int:
        if len(self) > 200_000:
            self.clear()
        got = self[token] = zlib.crc32(token.encode("utf-8", "replace")) % self.dims
        return got


_PATH_SLOTS, _WORD_SLOTS = _Slots(PATH_DIMS), _Slots(WORD_DIMS)


@lru_cache(maxsize=4096)
def _bits(tokens: tuple[str, ...]) -> int:
    out = 0
    for token in tokens:
        out |= 1 << _PATH_SLOTS[token]
    return out


def path_mask(element: Element) -> int:
    """The slots of an element's path as bits; each element keeps its own, made from its parent's."""
    todo = []
    node: Element | None = element
    while node is not None and node.mask is None:
        todo.append(node)
        node = node.parent
    mask = node.mask if node is not None else 0
    for node in reversed(todo):
        mask |= (_bits if len(node.tokens) < 32 else _bits.__wrapped__)(node.tokens)
        node.mask = mask
    return mask


def vectors(blocks: list[Block]) -> np.ndarray:
    """One row per block of a page."""
    n = len(blocks)
    x = np.zeros((n, DIMS), np.float32)
    if not n:
        return x
    masks, words, measures = [], [], []
    sizes = np.empty(n, np.int64)
    for i, b in enumerate(blocks):
        masks.append((path_mask(b.element) | _bits(("l:" + b.leaf,))).to_bytes(PATH_DIMS // 8, "little"))
        own = b.text.split(" ")
        sizes[i] = len(own)
        words += [_WORD_SLOTS[w] for w in b.text.lower().split(" ")]
        chars = len(b.text)
        before = blocks[i - 1].element.parent if i else None
        after = blocks[i + 1].element.parent if i + 1 < n else None
        measures.append((chars, min(1.0, b.linked / chars), min(1.0, b.text.count(",") * 10 / chars), b.text[-1] in ".!?", i / n, i + 1 == n, b.leaf in ("h1", "h2", "h3", "h4"), i == 0, before is b.element.parent, after is b.element.parent))
    rows = np.arange(n)
    x[:, :PATH_DIMS] = np.unpackbits(np.frombuffer(b"".join(masks), np.uint8).reshape(n, -1), axis=1, bitorder="little")
    counts = np.bincount(np.repeat(rows, sizes) * WORD_DIMS + np.array(words), minlength=n * WORD_DIMS).reshape(n, WORD_DIMS)
    x[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] = np.sqrt(counts / sizes[:, None])
    m = np.array(measures, np.float32)
    x[:, -MEASURES] = np.minimum(np.log1p(m[:, 0]) / 6, 2)
    x[:, -MEASURES + 1] = np.minimum(np.log1p(sizes) / 5, 2)
    x[:, -MEASURES + 2 :] = m[:, 1:]
    return x


class Labeller:
    """A one-layer bidirectional LSTM with a logistic output for each step."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        h = HIDDEN
        self.p = {"w": rng.normal(size=(DIMS, 8 * h)) / 12, "u": rng.normal(size=(2, h, 4 * h)) / np.sqrt(h), "b": np.zeros(8 * h), "o": rng.normal(size=2 * h) / 5, "c": np.zeros(1)}
        self.p["b"][h : 2 * h] = self.p["b"][5 * h : 6 * h] = 1  # forget gates start open
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _read(self, g: np.ndarray, u: np.ndarray, mask: np.ndarray, keep: list | None) -> np.ndarray:
        """States (time, page, hidden) of one direction from the gates' input ``g (time, page, 4 hidden)``."""
        steps, pages, h = *g.shape[:2], HIDDEN
        hs, cs = np.zeros((pages, h), np.float32), np.zeros((pages, h), np.float32)
        out = np.empty((steps, pages, h), np.float32)
        for t in range(steps):
            z = g[t] + hs @ u
            s = 1 / (1 + np.exp(-np.clip(z[:, : 3 * h], -30, 30)))
            a = np.tanh(z[:, 3 * h :])
            i, f, o = s[:, :h], s[:, h : 2 * h], s[:, 2 * h :]
            c = (f * cs + i * a) * mask[t]
            tc = np.tanh(c)
            new = o * tc * mask[t]
            if keep is not None:
                keep.append((i, f, o, a, cs, tc, hs))
            hs, cs = new, c
            out[t] = new
        return out

    @staticmethod
    def _pad(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        longest = max(map(len, pages))
        x = np.zeros((longest, len(pages), pages[0].shape[1]), np.float32)
        mask = np.zeros((longest, len(pages), 1), np.float32)
        for j, p in enumerate(pages):
            x[: len(p), j], mask[: len(p), j] = p, 1
        return x, mask

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """For each page's vectors the chance of each block to be main text."""
        out: list = [np.empty(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):  # pages of similar length together
            group = [order[at]]
            while at + len(group) < len(order) and len(group) < 256 and len(pages[order[at + len(group)]]) <= 1.25 * len(pages[group[0]]) + 4 and len(pages[order[at + len(group)]]) * (len(group) + 1) <= 1 << 14:
                group.append(order[at + len(group)])
            at += len(group)
            g, mask = self._pad([pages[i] @ self.p["w"] + self.p["b"] for i in group])
            h = HIDDEN
            left = self._read(g[:, :, : 4 * h], self.p["u"][0], mask, None)
            right = self._read(g[::-1, :, 4 * h :], self.p["u"][1], mask[::-1], None)[::-1]
            y = 1 / (1 + np.exp(-(left @ self.p["o"][:h] + right @ self.p["o"][h:] + self.p["c"])))
            for j, i in enumerate(group):
                out[i] = y[: len(pages[i]), j]
        return out

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 5, batch: int = 32, rate: float = 8e-3, seed: int = 3) -> None:
        """Adam on the mean log loss of blocks, through time."""
        rng, h = np.random.default_rng(seed), HIDDEN
        m, v, t = {k: np.zeros_like(x) for k, x in self.p.items()}, {k: np.zeros_like(x) for k, x in self.p.items()}, 0
        for epoch in range(epochs):
            order = sorted(rng.permutation(len(pages)).tolist(), key=lambda i: len(pages[i]) // 6)
            starts = rng.permutation(range(0, len(order), batch)).tolist()
            for at in starts:
                group = order[at : at + batch]
                x, mask = self._pad([pages[i] for i in group])
                # half of the blocks show no words and a quarter of the pages no path, so that none of them is leaned on alone
                x[:, :, PATH_DIMS : PATH_DIMS + WORD_DIMS] *= rng.random((*x.shape[:2], 1)) < 0.5
                x[:, :, :PATH_DIMS] *= rng.random((1, x.shape[1], 1)) < 0.75
                y = self._pad([labels[i][:, None] for i in group])[0][:, :, 0]
                p, grad = self.p, {}
                g = x @ p["w"] + p["b"]
                kept: tuple[list, list] = ([], [])
                left = self._read(g[:, :, : 4 * h], p["u"][0], mask, kept[0])
                right = self._read(g[::-1, :, 4 * h :], p["u"][1], mask[::-1], kept[1])[::-1]
                out = 1 / (1 + np.exp(-(left @ p["o"][:h] + right @ p["o"][h:] + p["c"])))
                d = (out - y) * mask[:, :, 0] / mask.sum()
                grad["c"] = d.sum(keepdims=True).reshape(1)
                grad["o"] = np.concatenate(((left * d[:, :, None]).sum((0, 1)), (right * d[:, :, None]).sum((0, 1))))
                dg, grad["u"] = np.empty_like(g), np.zeros_like(p["u"])
                for k, states in enumerate(kept):
                    mk = mask[::-1] if k else mask
                    dh_out = (d[::-1] if k else d)[:, :, None] * p["o"][k * h : (k + 1) * h]
                    dh, dc = np.zeros((x.shape[1], h), np.float32), np.zeros((x.shape[1], h), np.float32)
                    for s in range(len(states) - 1, -1, -1):
                        i, f, o, a, c0, tc, h0 = states[s]
                        dh = (dh + dh_out[s]) * mk[s]
                        dc = (dc + dh * o * (1 - tc * tc)) * mk[s]
                        z = np.concatenate((dc * a * i * (1 - i), dc * c0 * f * (1 - f), dh * tc * o * (1 - o), dc * i * (1 - a * a)), axis=1)
                        dg[len(states) - 1 - s if k else s, :, k * 4 * h : (k + 1) * 4 * h] = z
                        grad["u"][k] += h0.T @ z
                        dh, dc = z @ p["u"][k].T, dc * f
                flat = dg.reshape(-1, 8 * h)
                grad["w"], grad["b"] = x.reshape(-1, DIMS).T @ flat, flat.sum(0)
                t += 1
                lr = rate * min(1, t / 20) * (1 - epoch / (epochs + 1))
                norm = np.sqrt(sum(float((q * q).sum()) for q in grad.values()))
                for key, q in grad.items():
                    q = q / max(1.0, norm)
                    m[key] = 0.9 * m[key] + 0.1 * q
                    v[key] = 0.99 * v[key] + 0.01 * q * q
                    p[key] -= (lr * (m[key] / (1 - 0.9**t)) / (np.sqrt(v[key] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)


# --- pages with known answers ----------------------------------------------------------------------------------

#: Containers of article text: tag and class or id names.
MAIN = ["article", "article", "article", "main", "main article", "div.article", "div#content", "div.content", "div.post", "div.entry-content", "div.story-body", "section.content", "div.article-body", "article.post", "div.page-content", "div#main", "main#main", "div.text", "section.article", "div.post-content", "div.body", "article.entry"]
#: Containers of everything else.
REST = {
    "menu": ["nav", "nav", "nav.navbar", "div.menu", "div#nav", "ul.nav", "div.navigation", "nav.breadcrumb", "div.breadcrumbs", "div.topnav", "ul.menu", "header nav", "div.toc", "nav.pagination", "div.pagination", "div.links"],
    "header": ["header", "header", "div.header", "div#header", "div.masthead", "header.site-header", "div.top-bar", "div.branding", "div.logo"],
    "advert": ["div.ad", "div.ad", "div.ads", "div.advert", "div.advertisement", "aside.ad", "div.banner", "div.sponsored", "ins.adsbygoogle", "div.promo", "div#ad-top", "section.ads", "div.ad-slot", "div.promotion", "p.ad"],
    "notice": ["div.cookie", "div#cookie-banner", "div.cookie-notice", "div.notice", "div.alert", "div.consent", "section.gdpr", "p.notice", "div.popup", "div.modal", "div.warning", "div.message", "div.announcement"],
    "sidebar": ["aside", "aside", "div.sidebar", "div#sidebar", "aside.sidebar", "div.related", "section.related", "div.widget", "div.recommended", "div.trending", "div.side", "section.sidebar", "div.tags", "div.popular"],
    "form": ["form", "form", "form.search", "div.newsletter form", "form#login", "div.subscribe form", "form.signup", "form.contact", "div.search form"],
    "comments": ["div.comments", "section.comments", "div#comments", "section#comments", "ol.comment-list", "div.comment", "article.comment", "div#disqus_thread", "div.replies", "ul.comments", "div.responses", "div.reader-comments", "section.discussion", "div.user-comments", "div.comment-body", "li.comment"],
    "share": ["div.share", "div.social", "ul.social", "div.sharing", "div.follow"],
    "footer": ["footer", "footer", "footer", "div.footer", "div#footer", "footer.site-footer", "div.copyright", "div.legal", "div.bottom", "section.footer"],
}
_SYLLABLES = "an ba ce di en fo gu ha in ko le mi na or pu qua re sa ti un ver wi xa ye zo the ing tion heit que ción eau ß é ñ".split()
_COMMON = "the of and to in is that it was for on as with he his at by be this from or had not are but she which you all her an they were when we there can more der die und das ist nicht mit von auf ein eine sich le la les des est dans pour que qui sur pas el los las por con una para".split()
#: What stands in such parts on most sites, where no name tells them.
CUES = {
    "menu": ["Home", "News", "About", "About us", "Contact", "Products", "Services", "Blog", "Sport", "Start", "Login", "Archive", "Events", "Support", "Shop", "Help", "Menu", "Skip to content", "Next", "Previous", "Back"],
    "header": ["Welcome to", "Menu", "The daily", "Search", "Sign in", "Log in", "Subscribe"],
    "advert": ["Advertisement", "Sponsored", "Anzeige", "Publicité", "Advert", "Ad:", "Buy now", "Special offer", "Order today", "Save 20% today"],
    "notice": ["We use cookies", "This site uses cookies to improve your experience.", "By using this site you accept cookies.", "Accept all cookies", "Cookie settings", "JavaScript is disabled in your browser.", "Please enable JavaScript."],
    "sidebar": ["Related articles", "Related", "Popular posts", "Most read", "See also", "Trending", "Recent posts", "You may also like", "Tags", "Categories", "More stories", "Recommended"],
    "form": ["Subscribe to our newsletter", "Email", "Your email address", "Password", "Username", "Search", "Submit", "Send", "Sign up", "Name"],
    "comments": ["Comments", "Leave a reply", "Reader comments", "3 comments", "Responses", "Discussion"],
    "share": ["Share", "Share this", "Tweet", "Share on Facebook", "Follow us", "Email this", "Print", "WhatsApp", "Pin it"],
    "footer": ["©", "Copyright", "All rights reserved.", "Privacy policy", "Terms of use", "Imprint", "Impressum", "Contact us", "Sitemap", "Powered by"],
}


def write_page(rng: random.Random, named: bool = True) -> tuple[str, set[str]]:
    """A page and the texts of its article's blocks. Without ``named``, no name tells what a container holds: it has a random one or none, or pages are tables or bare blocks."""
    main: set[str] = set()
    odd = rng.random() < 0.2
    natural = rng.random() < 0.6

    def words(low: int, high: int) -> str:
        n = rng.randint(low, high)
        made = [rng.choice(_COMMON) if natural and rng.random() < 0.45 else "".join(rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n)]
        if n > 8 and rng.random() < 0.3:  # such words stand in articles too
            made[rng.randrange(n)] = rng.choice(CUES[rng.choice(list(CUES))]).lower()
        if odd:
            made = [w.upper() + "!!" if n % 2 else w + rng.choice(["", "%%%", "***", " |"]) for w in made]
        made[0] = made[0].capitalize()
        return " ".join(made) + rng.choice([".", ".", "", "!"])

    def text() -> str:
        return words(*rng.choice([(1, 3), (3, 9), (8, 30), (20, 80)]))

    def random_name() -> str:
        letters = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 6)))
        return rng.choice([f"css-{letters}{rng.randint(0, 99)}", letters, f"{letters[:2]}_{letters}", f"sc-{letters}", f"x{rng.randint(0, 999)}{letters}"])

    def tag(name: str, attribute: str, inner: str) -> str:
        extra = rng.choice(["", "", "", ' data-x="1"', ' style="margin:0"'])
        return f"<{name}{attribute}{extra}>{inner}</{name}>"

    def nameless(inner: str) -> str:
        for _ in range(rng.choice([1, 1, 2, 3])):
            attribute = rng.choice(["", f' class="{random_name()}"', f" class={random_name()}", f' id="{random_name()}"', f' class="{random_name()} {random_name()}"'])
            inner = tag(rng.choice(["div", "div", "div", "section"]), attribute, inner)
        return inner

    def wrap(kind: str, inner: str) -> str:
        if not named:
            return nameless(inner)
        for part in reversed(kind.split()):
            name = part.replace("#", ".").split(".")
            inner = tag(name[0], f' {"id" if "#" in part else "class"}="{name[1]}"' if len(name) > 1 else "", inner)
        return inner

    def links(kind: str, most: int) -> list[str]:
        return [f'<a href="/{i}">{rng.choice(CUES[kind]) if rng.random() < 0.6 else words(1, 3)}</a>' for i in range(rng.randint(1, most))]

    def listed(items: list[str]) -> str:
        way = rng.choice(["ul", "ul", "ul", "bar", "space", "div", "p"])
        if way == "ul":
            return "<ul>" + "".join(f"<li>{i}</li>" for i in items) + "</ul>"
        return {"bar": " | ", "space": " "}[way].join(items) if way in ("bar", "space") else "".join(f"<{way}>{i}</{way}>" for i in items)

    def told(kind: str) -> str:
        """A part that its words and links tell."""
        cue = rng.choice(CUES[kind])
        if kind in ("menu", "share"):
            return listed(links(kind, 7))
        if kind == "header":
            return rng.choice([f'<a href="/">{words(1, 2)}</a>', f"<h1><a href=/>{words(1, 3)}</a></h1>", f"<span>{cue}</span> <a href=/>{words(1, 2)}</a>", f'<a href="/"><b>{words(1, 2)}</b></a><p><a href=/x>{cue}</a></p>'])
        if kind == "advert":
            return rng.choice([f"{cue} {words(2, 12)}", f"<p>{cue}</p>", f'<a href="/x">{cue} {words(2, 8)}</a>', f"<p>{cue}: {words(2, 12)} <a href=/x>{words(1, 2)}</a></p>"])
        if kind == "notice":
            return rng.choice([f"{cue}", f"<p>{cue} {words(2, 8)}</p>", f"<p>{cue} <a href=/p>{words(1, 2)}</a></p><button>{rng.choice(['OK', 'Accept', 'Got it', 'Close'])}</button>"])
        if kind == "sidebar":
            return f"<{(h := rng.choice(['h2', 'h3', 'h4', 'b']))}>{cue}</{h}>" + listed([f'<a href="/{i}">{words(2, 8)}</a>' for i in range(rng.randint(1, 6))])
        if kind == "form":
            return f"<form><label>{cue}</label> <input name=q><button>{rng.choice(CUES['form'])}</button></form>"
        if kind == "comments":
            said = "".join(f"<{(d := rng.choice(['div', 'li', 'p']))}>{rng.choice(['Anna', 'Tom', 'guest', 'reader', words(1, 1)])} {rng.choice(['says:', 'wrote', 'on 3 May', '2 days ago'])} {text()} <a href=#>Reply</a></{d}>" for _ in range(rng.randint(1, 4)))
            return f"<h3>{cue}</h3>{said}"
        line = [cue, rng.choice(["2024", "2019", ""]), words(1, 4), *links("footer", 3)]
        rng.shuffle(line)
        return rng.choice(["<p>{}</p>", "{}", "<small>{}</small>"]).format(rng.choice([" ", " | ", " &middot; "]).join(["&copy; " * (rng.random() < 0.7), *line]))

    def rest(kind: str) -> str:
        if not named or rng.random() < 0.2:
            return wrap(rng.choice(REST[kind]), told(kind))
        parts = []
        for _ in range(rng.randint(1, 4)):
            shape = rng.choice(["list", "plain", "p", "div", "head", "span"]) if kind != "menu" else rng.choice(["list", "list", "inline"])
            if kind == "form":
                shape = rng.choice(["label", "p", "button", "plain"])
            body = text()
            parts.append({"list": "<ul>" + "".join(f'<li><a href="/x">{words(1, 3)}</a></li>' for _ in range(rng.randint(1, 6))) + "</ul>", "inline": " | ".join(f'<a href="#">{words(1, 2)}</a>' for _ in range(rng.randint(1, 5))), "plain": body, "p": f"<p>{body}</p>", "div": f"<div>{body}</div>", "head": f"<h3>{words(1, 4)}</h3><p>{body}</p>", "span": f"<span>{body}</span>", "label": f"<label>{words(1, 3)}</label><input name=q>", "button": f"<button>{words(1, 2)}</button>"}[shape])
        lead = {"footer": "&copy; ", "notice": rng.choice(["Cookies ", ""])}.get(kind, "")
        return wrap(rng.choice(REST[kind]), lead + "".join(parts))

    def own() -> str:
        body = text()
        main.add(" ".join(body.split()))
        return body

    def block() -> str:
        shape = rng.choice(["p"] * 9 + ["open", "list", *([] if named else ["list", "list", "h2"]), "quote", "h2", "div", "table", "grid", "br", "pre", "b", "figure", "dl"])
        if shape == "list":
            kind = rng.choice(["ul", "ol"])
            return f"<{kind}>" + "".join(f"<li>{own()}</li>" for _ in range(rng.randint(1, 5))) + f"</{kind}>"
        if shape == "grid":
            wide = rng.randint(1, 3)
            rows = [f"<tr>{''.join(f'<th>{own()}</th>' for _ in range(wide))}</tr>"] + [f"<tr>{''.join(f'<td>{own()}</td>' for _ in range(wide))}</tr>" for _ in range(rng.randint(0, 3))]
            return f"<table>{''.join(rows)}</table>"
        body = own()
        if shape == "p" and rng.random() < 0.2:
            first, _, more = body.partition(" ")
            return f"<p><{(i := rng.choice(['b', 'i', 'a', 'em', 'span']))}>{first}</{i}> {more}</p>"
        return {"p": f"<p>{body}</p>", "open": f"<p>{body}", "quote": f"<blockquote><p>{body}</p></blockquote>", "h2": f"<h2>{body}</h2>", "div": f"<div>{body}</div>", "table": f"<table><tr><td>{body}</td></tr></table>", "br": f"<p>{body}<br>", "pre": f"<pre>{body}</pre>", "b": f"<p><b>{body}<br>", "figure": f"<figure><figcaption>{body}</figcaption></figure>", "dl": f"<dl><dd>{body}</dd></dl>"}[shape]

    article = [f"<h1>{own()}</h1>"] if rng.random() < 0.8 else []
    for _ in range(rng.choice([1, 1, 2, 4, 7, 12, 20] if named else [1, 2, 4, 6, 9, 12, 20])):
        article.append(block())
        if rng.random() < 0.07:
            article.append(rest(rng.choice(["advert", "share", "sidebar", "form", "menu", "notice"])))
    if rng.random() < 0.12:
        article.append(rest(rng.choice(["comments", "footer", "share"])))
    inner = "".join(article)
    bare = not named and rng.random() < 0.35
    if bare and rng.random() < 0.2:  # text without any element
        main.clear()
        inner = own()
    core = inner if bare else wrap(rng.choice(MAIN), inner)
    if rng.random() < 0.35 and not bare:
        core = wrap(rng.choice(["div.wrapper", "div.container", "div.page", "div#root", "div.row div.col", "section"]), core)
    first = [rest(k) for k in ("header", "menu", "notice", "advert", "sidebar", "form") if rng.random() < (0.45 if named else 0.3)]
    last = [rest(k) for k in ("advert", "share", "comments", "sidebar", "menu", "form", "notice", "footer") if rng.random() < (0.4 if named else 0.25)]
    if not named and rng.random() < 0.3:
        last = []
    if not named and rng.random() < 0.25:  # a page laid out as a table
        columns = [f"<td>{''.join(first[-1:])}</td>" if first else "", f"<td>{core}</td>", f"<td>{last[0]}</td>" if last else ""]
        rows = [f"<tr><td>{x}</td></tr>" for x in first[:-1]] + [f"<tr>{''.join(columns)}</tr>"] + [f"<tr><td>{x}</td></tr>" for x in last[1:]]
        page = f"<table{rng.choice(['', ' width=100%', ' border=0'])}>{''.join(rows)}</table>"
    else:
        page = f"{''.join(first)}<!-- x -->{core}{''.join(last)}"
    if not named and rng.random() < 0.2:
        return page, main
    return f'<!DOCTYPE html><html lang="en"><head><title>{words(2, 6)}</title><style>p{{margin:0}}</style></head><body>{page}</body></html>', main


@lru_cache(maxsize=2)
def trained(pages: int = TRAIN_PAGES, seed: int = 17) -> Labeller:
    """The labeller after training on ``pages`` written pages; always the same for the same numbers."""
    rng = random.Random(seed)
    xs, ys = [], []
    for i in range(pages):
        page, main = write_page(rng, named=i % 2 == 0)
        if blocks := blocks_of(page):
            xs.append(vectors(blocks))
            ys.append(np.array([b.text in main for b in blocks], np.float32))
    labeller = Labeller()
    labeller.train(xs, ys)
    return labeller


def main_texts(pages: list[str | None], labeller: Labeller) -> list[str]:
    """For each page the texts of the blocks labelled as main text, joined by one newline."""
    parsed = [blocks_of(p) for p in pages]
    chances = labeller.probabilities([vectors(b) for b in parsed])
    return ["\n".join(b.text for b, c in zip(blocks, chance, strict=True) if c >= 0.5) for blocks, chance in zip(parsed, chances, strict=True)]


_WEIGHTS: dict[int, dict[str, np.ndarray]] = {}


def _weights(spark: SparkSession, pages: int) -> dict[str, np.ndarray]:
    """A trained labeller's weights, about 70,000 numbers; trained once a process, in a task, where numpy has the task's cores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(trained(pages).p)], pa.binary())], names=["weights"])

    if pages not in _WEIGHTS:
        _WEIGHTS[pages] = pickle.loads(spark.range(0, 1, 1, 1).mapInArrow(run, "weights binary").first()["weights"])
    return _WEIGHTS[pages]


def extract_main(pages: DataFrame, train_pages: int = TRAIN_PAGES) -> DataFrame:
    """``pages (page_id, url, html, ...)`` to ``page_id, url, text, n_chars``: one row per row, the article's text.

    References are decoded, white space in a block is one space, blocks are trimmed and joined by ``\\n`` in page
    order. Null, empty and text-free pages have an empty text. Text outside any element is a block like others.
    Null ids and urls stay, repeated rows are repeated, other columns are ignored, an empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(_weights(pages.sparkSession, train_pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller()
        labeller.p = shared.value
        for part in batches:
            for at in range(0, part.num_rows, 128):
                piece = part.slice(at, 128)
                texts = main_texts(piece.column(2).to_pylist(), labeller)
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
