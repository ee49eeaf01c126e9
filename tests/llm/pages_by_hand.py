"""Hand-written pages in the styles of a dozen kinds of site, and the main text of each."""

PAGES: dict[str, tuple[str, list[str]]] = {}


def page(name: str, html: str, *blocks: str) -> None:
    PAGES[name] = (html, list(blocks))


page(
    "blog",
    """<!doctype html><html><head><title>Bees &#8211; A Field Diary</title><style>p{margin:0}</style></head><body class="single">
<div id="page"><header id="masthead" class="site-header"><p class="site-title"><a href="/">A Field Diary</a></p>
<nav class="main-navigation"><ul><li><a href="/">Home</a></li><li><a href="/about">About</a></li><li><a href="/contact">Contact</a></li></ul></nav></header>
<div id="content"><main id="main"><article class="post type-post"><header class="entry-header"><h1 class="entry-title">The bees came back in April</h1></header>
<div class="entry-content"><p>We had given up on the hive by the wall. In February there was no sound from it at all, and the snow lay on the roof for weeks.</p>
<p>Then, on the ninth of April, a single bee stood on the board in front of the entrance &amp; cleaned its wings.</p>
<h2>What we did differently</h2><p>Nothing, to be honest. We left more honey in the box than in other years, and we did not open it once.</p></div></article>
<div id="comments" class="comments-area"><h2>3 thoughts on this post</h2><ol class="comment-list"><li class="comment"><p>Lovely, ours did not make it this year.</p></li>
<li class="comment"><p>How much honey did you leave?</p></li></ol><form class="comment-form"><label>Name</label><input name="n"><button>Post comment</button></form></div></main>
<aside id="secondary" class="widget-area"><section class="widget"><h2>Recent posts</h2><ul><li><a href="/1">Sowing peas</a></li><li><a href="/2">The pond</a></li></ul></section></aside></div>
<footer id="colophon" class="site-footer"><p>Proudly powered by a blog engine</p></footer></div></body></html>""",
    "The bees came back in April",
    "We had given up on the hive by the wall. In February there was no sound from it at all, and the snow lay on the roof for weeks.",
    "Then, on the ninth of April, a single bee stood on the board in front of the entrance & cleaned its wings.",
    "What we did differently",
    "Nothing, to be honest. We left more honey in the box than in other years, and we did not open it once.",
)
page(
    "newspaper",
    """<html><body><div class="topbar"><a href="/">The Evening Ledger</a> <a href="/subscribe">Subscribe</a></div>
<div class="nav"><a href="/world">World</a> <a href="/business">Business</a> <a href="/sport">Sport</a></div>
<div class="ad ad-top">Advertisement: save on winter tyres</div>
<div class="story"><h1>Council votes to keep the old bridge</h1>
<p>The city council voted on Tuesday night to repair the iron bridge at Mill Lane rather than replace it, ending a dispute that had lasted for eleven years.</p>
<p>The repair will cost four million, less than half of the price of a new bridge, according to a report by the city's engineers.</p>
<div class="advert">Sponsored: the best mortgage rates of the month</div>
<p>"It is not the cheapest way over the river, but it is the one that people want," said the mayor after the vote.</p></div>
<div class="related"><h3>Related</h3><ul><li><a href="/a">A short history of the bridge</a></li><li><a href="/b">Floods close Mill Lane</a></li></ul></div>
<div class="cookie-banner">We use cookies to improve your experience. <button>Accept</button></div>
<div class="footer">Copyright 2024 The Evening Ledger. All rights reserved.</div></body></html>""",
    "Council votes to keep the old bridge",
    "The city council voted on Tuesday night to repair the iron bridge at Mill Lane rather than replace it, ending a dispute that had lasted for eleven years.",
    "The repair will cost four million, less than half of the price of a new bridge, according to a report by the city's engineers.",
    '"It is not the cheapest way over the river, but it is the one that people want," said the mayor after the vote.',
)
page(
    "wiki",
    """<html><body><div id="mw-navigation"><div class="menu"><ul><li><a href="/m">Main page</a></li><li><a href="/r">Random page</a></li></ul></div></div>
<div id="content" class="mw-body" role="main"><h1 id="firstHeading">Tawny owl</h1><div id="bodyContent">
<p>The <b>tawny owl</b> is a stocky, medium-sized owl commonly found in woodlands across Europe and western Siberia.</p>
<div id="toc" class="toc"><ul><li><a href="#d">1 Description</a></li><li><a href="#b">2 Behaviour</a></li></ul></div>
<h2>Description</h2><p>The tawny owl is a robust bird, 37 to 46 cm in length, with an 81 to 105 cm wingspan. Its large rounded head lacks ear tufts.</p>
<h2>Behaviour</h2><ul><li>It hunts mainly at night.</li><li>It feeds on rodents and other small animals.</li></ul>
</div></div><div id="footer" role="contentinfo"><ul><li>This page was last edited on 3 May.</li><li><a href="/p">Privacy policy</a></li></ul></div></body></html>""",
    "Tawny owl",
    "The tawny owl is a stocky, medium-sized owl commonly found in woodlands across Europe and western Siberia.",
    "Description",
    "The tawny owl is a robust bird, 37 to 46 cm in length, with an 81 to 105 cm wingspan. Its large rounded head lacks ear tufts.",
    "Behaviour",
    "It hunts mainly at night.",
    "It feeds on rodents and other small animals.",
)
page(
    "manual",
    """<html><body><div class="related" role="navigation"><ul><li><a href="genindex">index</a></li><li><a href="next">next</a></li></ul></div>
<div class="document"><div class="body" role="main"><section id="install"><h1>Installing the tool</h1>
<p>The tool needs a compiler and about two hundred megabytes of free space. Unpack the archive and change into the new folder.</p>
<pre>./configure --prefix=/opt/tool
make install</pre><p>If the last step fails, look at the file config.log; its last lines usually say what is missing.</p></section></div></div>
<div class="sidebar"><h3>Table of contents</h3><ul><li><a href="#install">Installing the tool</a></li></ul><h3>This page</h3><p><a href="_sources">Show source</a></p></div>
<div class="footer">Created with a documentation generator.</div></body></html>""",
    "Installing the tool",
    "The tool needs a compiler and about two hundred megabytes of free space. Unpack the archive and change into the new folder.",
    "./configure --prefix=/opt/tool make install",
    "If the last step fails, look at the file config.log; its last lines usually say what is missing.",
)
page(
    "government",
    """<html><body><a class="skip-link" href="#main">Skip to main content</a><div class="cookie-banner" role="region"><p>We would like to use cookies to understand how you use this site.</p><button>Accept</button><button>Reject</button></div>
<header role="banner"><a href="/">Ministry of Waterways</a></header><div class="breadcrumbs"><ol><li><a href="/">Home</a></li><li><a href="/boats">Boats</a></li></ol></div>
<main id="main" role="main"><h1>Register a boat</h1><p>You must register a boat before you use it on any of the inland waterways that the ministry looks after.</p>
<p>You will need the following documents:</p><ul><li>proof of insurance</li><li>a safety certificate that is less than four years old</li></ul><p>Registration lasts for twelve months.</p></main>
<footer role="contentinfo"><ul><li><a href="/help">Help</a></li><li><a href="/privacy">Privacy</a></li></ul><p>All content is available under the open licence.</p></footer></body></html>""",
    "Register a boat",
    "You must register a boat before you use it on any of the inland waterways that the ministry looks after.",
    "You will need the following documents:",
    "proof of insurance",
    "a safety certificate that is less than four years old",
    "Registration lasts for twelve months.",
)
page(
    "recipe",
    """<html><body><header class="header"><a href="/">Kitchen Notes</a></header><div class="search"><form action="/s"><input name="q"><button>Search</button></form></div>
<div class="main"><div class="recipe content"><h1>Barley soup with leeks</h1><p>A thick soup for cold evenings. It keeps for three days and is better on the second.</p>
<h2>Ingredients</h2><ul><li>200 g pearl barley</li><li>3 leeks</li><li>1 litre of stock</li></ul>
<h2>Method</h2><ol><li>Wash the barley and leave it in water over night.</li><li>Cut the leeks into rings and fry them gently in butter until they are soft.</li><li>Add the barley and the stock, and simmer for fifty minutes.</li></ol></div>
<div class="newsletter"><p>Get a recipe by mail every Friday!</p><form><input type="email"><button>Sign up</button></form></div></div>
<div class="comments"><h3>Comments</h3><div class="comment"><p>Made this with spelt, very good.</p></div></div><footer><p>&copy; Kitchen Notes</p></footer></body></html>""",
    "Barley soup with leeks",
    "A thick soup for cold evenings. It keeps for three days and is better on the second.",
    "Ingredients",
    "200 g pearl barley",
    "3 leeks",
    "1 litre of stock",
    "Method",
    "Wash the barley and leave it in water over night.",
    "Cut the leeks into rings and fry them gently in butter until they are soft.",
    "Add the barley and the stock, and simmer for fifty minutes.",
)
page(
    "magazine",
    """<html><body><div id="root"><div class="a1"><nav><a href="/">Longform</a><button>Sign in</button></nav></div>
<article><section><h1>The man who counted every lighthouse</h1><figure><img src="x.jpg"><figcaption>The light at Cape Wrath in 1971.</figcaption></figure>
<p>On a wet morning in 1958 a young clerk named Arthur Pell took a bus to the coast with a notebook, a flask of tea and a plan that would fill the next thirty years of his life.</p>
<blockquote><p>I never meant to see them all. I only meant to see the next one.</p></blockquote>
<p>He began in the north, because the buses were cheaper there, and worked his way down the east coast one weekend at a time.</p></section></article>
<aside><h2>More from this issue</h2><p><a href="/x">Why we still love paper maps</a></p></aside>
<dialog class="paywall"><p>You have two free articles left this month. Subscribe now.</p></dialog><footer><a href="/terms">Terms</a> <a href="/privacy">Privacy</a></footer></div></body></html>""",
    "The man who counted every lighthouse",
    "The light at Cape Wrath in 1971.",
    "On a wet morning in 1958 a young clerk named Arthur Pell took a bus to the coast with a notebook, a flask of tea and a plan that would fill the next thirty years of his life.",
    "I never meant to see them all. I only meant to see the next one.",
    "He began in the north, because the buses were cheaper there, and worked his way down the east coast one weekend at a time.",
)
page(
    "homepage of the nineties",
    """<HTML><BODY BGCOLOR=white><UL><LI><A HREF="index.htm">Start</A><LI><A HREF="about.htm">About</A><LI><A HREF="links.htm">Links</A></UL><HR>
<H1>My father's radios</H1><P>My father repaired radios for forty years in a shop no wider than a bed. When he died he left me sixty-three of them, all in working order.
<P>This page lists the ones that I have kept. If you know more about any of them, I would be glad to hear from you.
<HR><DIV CLASS=footer>Last updated in March 1999</DIV></BODY></HTML>""",
    "My father's radios",
    "My father repaired radios for forty years in a shop no wider than a bed. When he died he left me sixty-three of them, all in working order.",
    "This page lists the ones that I have kept. If you know more about any of them, I would be glad to hear from you.",
)
page(
    "plain markup",
    """<html><body><div><ul><li><a href="/">Home</a></li><li><a href="/about">About</a></li><li><a href="/archive">Archive</a></li></ul></div>
<div><h1>Notes on a small garden</h1><p>The soil here is heavy clay, and for the first two years nothing that we planted in it lived longer than a summer.</p>
<p>What changed it was not fertiliser but patience: leaves in autumn, straw in spring, and no spade at all.</p></div>
<div><a href="/imprint">Imprint</a> <a href="/privacy">Privacy</a></div></body></html>""",
    "Notes on a small garden",
    "The soil here is heavy clay, and for the first two years nothing that we planted in it lived longer than a summer.",
    "What changed it was not fertiliser but patience: leaves in autumn, straw in spring, and no spade at all.",
)
page(
    "press release",
    """<html><body><div id="header"><div class="logo">Norwind Power</div><div class="login"><a href="/login">Log in</a></div></div><ul class="menu"><li><a href="/p">Products</a></li><li><a href="/c">Careers</a></li></ul>
<div id="main-content"><h1>Norwind opens its third wind farm</h1><p>Norwind Power today opened its third offshore wind farm, forty kilometres off the coast, after five years of planning and two of construction.</p>
<p>The ninety turbines will supply about half a million households. The first power reached the grid in the night of Sunday.</p>
<table><tr><td>Turbines</td><td>90</td></tr><tr><td>Water depth</td><td>31 m</td></tr></table></div>
<div class="share social"><a href="#">Tweet</a> <a href="#">Share</a></div><div id="footer"><p>Norwind Power, Harbour Street 1. All rights reserved.</p></div></body></html>""",
    "Norwind opens its third wind farm",
    "Norwind Power today opened its third offshore wind farm, forty kilometres off the coast, after five years of planning and two of construction.",
    "The ninety turbines will supply about half a million households. The first power reached the grid in the night of Sunday.",
    "Turbines",
    "90",
    "Water depth",
    "31 m",
)
page(
    "science",
    """<html><body><nav class="journal-nav"><a href="/i">Issues</a><a href="/s">Submit</a></nav><main><article><header><h1>Salt tolerance in three species of reed</h1></header>
<section class="abstract"><h2>Abstract</h2><p>We grew three species of reed at five levels of salinity for two seasons and measured height, leaf area and the share of plants that flowered.</p></section>
<section><h2>Results</h2><p>Height fell with salinity in all species (p &lt; 0.01), but far less in the plants that came from the coast than in those from inland lakes.</p></section></article></main>
<aside class="recommended"><h3>Recommended articles</h3><ul><li><a href="/1">Reeds as a source of fibre</a></li></ul></aside><footer><p>Copyright the authors.</p></footer></body></html>""",
    "Salt tolerance in three species of reed",
    "Abstract",
    "We grew three species of reed at five levels of salinity for two seasons and measured height, leaf area and the share of plants that flowered.",
    "Results",
    "Height fell with salinity in all species (p < 0.01), but far less in the plants that came from the coast than in those from inland lakes.",
)
page(
    "travel",
    """<html><body><div class="header"><a href="/">Slow Trains</a></div><div class="navbar"><a href="/e">Europe</a><a href="/a">Asia</a></div>
<div class="post"><h1>Two days to Narvik</h1><div class="post-body"><p>The train leaves Stockholm at ten past six in the evening, and by the time the dining car closes there is nothing outside but forest.</p>
<p>I woke at four, because it was light, and saw the first reindeer standing next to the track as if they were waiting for a connection.</p></div></div>
<div class="widget popular"><h4>Popular</h4><ul><li><a href="/1">Across the Alps by night</a></li><li><a href="/2">The slowest express</a></li></ul></div>
<div class="subscribe"><p>Join four thousand readers and get new stories by mail.</p></div><div class="site-footer footer"><p>Contact | Privacy</p></div><script>var x = "<p>not text</p>";</script></body></html>""",
    "Two days to Narvik",
    "The train leaves Stockholm at ten past six in the evening, and by the time the dining car closes there is nothing outside but forest.",
    "I woke at four, because it was light, and saw the first reindeer standing next to the track as if they were waiting for a connection.",
)
