"""Pages with their main text, in layouts that no training page has.

Each layout is marked up by hand; ``{a}`` to ``{e}`` are blocks of the main text, all else
is around it.
"""

SENTENCES = (
    "The ferry leaves the northern harbour at dawn and reaches the island before the market opens.",
    "Nobody had repaired the old lighthouse since the storm, although the village council met about it twice.",
    "In spring the orchards behind the school are white with blossom, and the bees come down from the hills.",
    "Her notebook lists every bird she saw that year, with the date, the weather and the place.",
    "A new bridge would shorten the way to the valley by an hour, according to the engineers.",
    "The bakery sells its last loaves at noon; after that only the tea room stays open.",
    "When the river froze, carts crossed it for three weeks, and a fair was held on the ice.",
    "Most of the letters were written in pencil, and some lines can no longer be read.",
    "The choir sang in the yard because the hall was too small for all who had come.",
    "He learnt to mend nets from his grandfather and still uses the same wooden needle.",
)

LAYOUTS = (
    "<table><tr><td class=left><a href=/>Start</a><br><a href=/n>News</a></td><td><h2>{a}</h2><p>{b}<p>{c}<p>{d}</td></tr>"
    "<tr><td colspan=2>Copyright notice. Imprint</td></tr></table>",
    "<div id=top><ul><li><a href=/>Home</a><li><a href=/x>Topics</a></ul></div><div id=main-text><h1>{a}</h1><div>{b}</div>"
    "<div>{c}</div><div>{d}</div></div><div id=bottom>Terms of use | Contact</div>",
    "<section><nav><a href=a>Prev</a> <a href=b>Next</a></nav><h1>{a}</h1><p>{b}</p><blockquote>{c}</blockquote><p>{d}</p></section>"
    "<section class=related-links><h3>More to read</h3><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></section>",
    "<div class=cookie-banner><p>We use cookies. <button>Accept</button></p></div><div class=story><h1>{a}</h1><p>{b}</p>"
    "<div class=ad><p>Buy now and save.</p></div><p>{c}</p><p>{d}</p></div>",
    "<body><center><h1>{a}</h1></center><p>{b}<p>{c}<ul><li>{d}<li>{e}</ul><hr><small>Last changed by the editors. "
    "<a href=mail>Write to us</a></small>",
    "<header><h2>The Daily Leaf</h2><form><input name=q><button>Search</button></form></header><main><h1>{a}</h1><p><b>{b}</b></p><p>{c}</p>"
    "<p>{d}</p></main><aside><h3>Popular</h3><p><a href=1>Top story</a></p></aside><footer>All rights reserved</footer>",
    "<div class=wrapper><div class=menu><span><a href=1>A</a></span> <span><a href=2>B</a></span></div><div class=entry><h3>{a}</h3>"
    "<p>{b}</p><p>{c}</p><p>{d}</p></div><div class=comments><p>Anna: I was there too.</p><p>Ben: Lovely.</p></div></div>",
    "<article><h1>{a}</h1><figure><img src=x><figcaption>{e}</figcaption></figure><p>{b}</p><p>{c}</p><p>{d}</p></article>"
    "<div class=share><a href=1>Share</a><a href=2>Print</a></div>",
    "<div class=page><div class=col1><h4>Sections</h4><a href=1>Sport</a><br><a href=2>Weather</a></div><div class=col2><h1>{a}</h1><p>{b}</p>"
    "<p>{c}</p><p>{d}</p></div><div class=col3><p>Advertisement</p><p>Cheap flights from 9.99</p></div></div>",
    "<div role=main><h1>{a}</h1><p>{b}</p><ol><li>{c}</li><li>{d}</li></ol><p>{e}</p></div><div role=contentinfo><p>Imprint and "
    "privacy</p></div><script>var x = '<p>no text</p>';</script>",
)


def pages():
    """(html, main text) of twenty pages."""
    out = []
    for k in range(2 * len(LAYOUTS)):
        layout = LAYOUTS[k % len(LAYOUTS)]
        own = [SENTENCES[(3 * k + i) % len(SENTENCES)] for i in range(10)]
        # A headline, two short and two long paragraphs.
        blocks = {"a": own[0][:40].rsplit(" ", 1)[0], "b": own[1], "c": f"{own[2]} {own[3]} {own[4]}", "d": f"{own[5]} {own[6]}", "e": own[7]}
        names = sorted((n for n in blocks if f"{{{n}}}" in layout), key=lambda n: layout.index(f"{{{n}}}"))
        out.append((layout.format(**blocks), "\n".join(blocks[n] for n in names)))
    return out
