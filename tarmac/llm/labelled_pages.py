"""Labelled pages: what is below ``mainlabel`` and not below ``boilerlabel`` is content.

Each page shows elements that usually hold no article text next to some that do.
"""

_LINE = "Some words that stand for a sentence of the usual length, with a comma and an end."
_PROSE = "".join(f"<p>{_LINE} {_LINE} {_LINE}</p>" for _ in range(3))
_LINKS = "<ul>" + "<li><a href='/x'>One link</a></li>" * 6 + "</ul>"

#: Classes, ids and roles of elements beside the article, and of some within it that are not its text.
BESIDE = (
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead topbar banner footer copyright sidebar aside rail widget "
    "related recommended trending popular tags categories archive pagination pager toc "
    "ad ads advert advertisement adbox sponsor sponsored promo promotion commercial "
    "cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login search "
    "social share sharing follow comment comments respond reply replies disqus discussion feedback "
    "form contact skip hidden legal disclaimer complementary contentinfo"
).split()
WITHIN = "content article post entry story body text main page container wrapper row col column section blog title headline".split()

PAGES = [
    f"<body><{tag}>{_LINKS}{_LINE}</{tag}><article class='mainlabel'><h1>{_LINE}</h1>{_PROSE}</article></body>"
    for tag in ("nav", "header", "footer", "aside", "form", "menu", "dialog")
]
PAGES += [
    f"<body><div class='{name}'>{_LINKS}<p>{_LINE}</p></div><div class='mainlabel'><h1>{_LINE}</h1>{_PROSE}"
    f"<div class='boilerlabel'><div class='{name}'>{_LINE}</div></div>{_PROSE}</div></body>"
    for name in BESIDE
]
PAGES += [
    f"<body><div>{_LINKS}</div><div class='{name}'><div class='mainlabel'><h2>{_LINE}</h2>{_PROSE}"
    f"<ul><li>{_LINE}</li><li>{_LINE}</li></ul><blockquote>{_LINE}</blockquote>"
    f"<p>{_LINE} <a href='/y'>words of a link</a> {_LINE}</p><table><tr><td>{_LINE}</td></tr></table></div></div></body>"
    for name in WITHIN
]
PAGES += [
    f"<body><article><div class='mainlabel'><header><h1>{_LINE}</h1></header>{_PROSE}<figure><figcaption>{_LINE}</figcaption></figure>"
    f"<div class='boilerlabel'><aside>{_LINE}</aside><nav>{_LINKS}</nav><form>{_LINE}</form><footer>{_LINE}</footer></div>"
    f"{_PROSE}</div></article></body>"
]
