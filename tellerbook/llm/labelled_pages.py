"""Small pages in common layouts, written and labelled by hand to train the extractor.

The attribute ``data-content`` marks what is article, ``data-other`` what within it
is not. Both are ignored as features.
"""

from __future__ import annotations

_LONG = (
    "The council met on Tuesday to discuss the new bridge, and after three hours of debate it agreed to fund the "
    "first part of the work. Engineers expect that the road will be closed for most of the summer."
)
_NEXT = (
    "Residents said that they had waited for years. One of them, who has lived by the river since childhood, "
    "remembers how the old crossing was washed away in a single night."
)
_SHORT = "It was a quiet evening."
_MENU = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul>'
_COMMENT = "<p>I do not agree with this at all, the old bridge was fine for everyone.</p>"

PAGES = (
    f'<html><body><div id="header"><a href="/">The Daily</a><p>Your local paper since 1901</p></div>'
    f'<div class="menu">{_MENU}</div><div class="content" data-content="1"><h1>Bridge agreed</h1><p>{_LONG}</p>'
    f'<p>{_SHORT}</p><p>{_NEXT}</p></div><div class="sidebar"><h3>Most read</h3>{_MENU}<p>Sign up for our letter.</p>'
    f'</div><div id="footer"><p>Copyright 2024 The Daily. All rights reserved.</p></div></body></html>',
    f'<html><body><header><h1>My blog</h1><p>Notes on rivers</p></header><nav>{_MENU}</nav><main>'
    f'<div class="post" data-content="1"><h2>On bridges</h2><p>{_LONG}</p><ul><li>Stone bridges last long.</li>'
    f"<li>Wooden ones do not, unless they are covered.</li></ul><blockquote><p>{_NEXT}</p></blockquote></div>"
    f'<section class="comments" id="comments"><h3>3 comments</h3><div class="comment">{_COMMENT}</div>'
    f'<div class="comment"><p>{_LONG}</p></div></section></main><aside><h3>About</h3><p>I write about rivers.</p>'
    f"</aside><footer><p>Powered by a blog engine</p></footer></body></html>",
    f'<body><div class="cookie-notice"><p>This site uses cookies to give you the best experience. By going on you '
    f'accept our policy.</p><button>Accept</button></div><div class="wrapper"><div class="article-body" '
    f'data-content="1"><p>{_LONG}</p><div class="advert" data-other="1"><p>Buy two pairs of shoes and get the third '
    f"one free, only this week.</p></div><p>{_NEXT}</p><p>{_SHORT}</p></div></div>"
    f'<form action="/subscribe"><label>Email</label><p>Get our news by mail every morning.</p></form></body>',
    f'<table><tr><td class="nav">{_MENU}</td><td class="main" data-content="1"><h1>Bridge agreed</h1><p>{_LONG}'
    f'<p>{_NEXT}</td><td class="ads"><p>Cheap flights to the south. Book now and save.</p></td></tr></table>',
    f'<body data-content="1"><h1>Bridge agreed</h1><p>{_LONG}</p><p>{_NEXT}</p><h2>History</h2><p>{_SHORT}</p></body>',
    f'<body><div class="notice"><p>You are reading an old version of this page.</p></div><div role="main">'
    f'<article data-content="1"><header><h1>Bridge agreed</h1></header><p>{_LONG}</p><figure><figcaption>The '
    f"bridge in spring.</figcaption></figure><p>{_NEXT}</p><pre>span = 120</pre></article>"
    f'<div class="related"><h3>Related</h3><ul><li><a href="/1">A longer road</a></li><li><a href="/2">The flood</a>'
    f'</li></ul></div><div class="reader-comments"><p>{_NEXT}</p><p>Thanks for this.</p></div></div>'
    f'<div class="footer-links">{_MENU}<p>Terms and conditions apply.</p></div></body>',
    f'<body><div class="top-bar"><a href="/in">Log in</a></div><div class="breadcrumb"><a href="/">Home</a> &gt; News'
    f'</div><div class="story" data-content="1"><h1>Bridge agreed</h1><div>{_LONG}</div><div>{_NEXT}</div>'
    f'<table><tr><th>Year</th><th>Length</th></tr><tr><td>1901</td><td>80 m</td></tr></table></div>'
    f'<div class="share"><a href="#">Share</a><a href="#">Print</a></div><div class="promo banner"><p>Our summer sale '
    f'has begun. Save up to half on all garden chairs until Sunday.</p></div><div class="copyright">2024</div></body>',
    f'<body><nav>{_MENU}</nav><div class="ad">{_LONG}</div><section class="text" data-content="1"><h1>Bridge</h1>'
    f"<p>{_SHORT}</p><p>{_LONG}</p></section><div class='widget'><p>Weather today: sunny, with some clouds.</p></div>"
    f"<footer>Contact us at the office in the old mill, open from nine to five.</footer></body>",
)
