"""The small labelled table of the block classifier: pages whose main-text blocks carry ``data-keep``."""

PAGES = [
    """<html><head><title>On rivers</title><style>p{}</style></head><body>
<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul></nav>
<div class="ad">Buy two pairs of shoes and get the third one free this week only.</div>
<article><h1 data-keep>How rivers find their way to the sea</h1>
<p data-keep>Rivers start as small streams in the hills, where rain and melting snow gather, and they grow as other streams join them on the way down.</p>
<p data-keep>Water is patient.</p>
<p data-keep>Over thousands of years the bed moves from side to side, and what was once a bend becomes a lake that slowly fills with reeds and mud.</p></article>
<footer>&copy; 2020 River Times &middot; All rights reserved.</footer></body></html>""",
    """<body><header><div>Morning Paper</div><p>The paper for people who get up early and read on the train.</p></header>
<div id="content"><h1 data-keep>Council votes on the bridge</h1>
<p data-keep>The council voted late on Tuesday to close the old bridge for repairs that may take two years, said <a href="/m">the mayor</a> after the meeting.</p>
<p data-keep>No date was given.</p>
<h2 data-keep>What happens next</h2>
<p data-keep>Buses will take the long way round and a ferry for walkers will run every twenty minutes from six in the morning until midnight.</p>
<ul><li data-keep>The ferry is free of charge for everybody.</li><li data-keep>Bicycles can be taken along outside the rush hour.</li></ul></div>
<aside><h3>Most read</h3><ul><li><a href="/1">Ten walks near the town</a></li><li><a href="/2">Why the market moved</a></li></ul></aside>
<div class="comments"><h3>Comments</h3><p>I cross this bridge every day and nobody asked me about it, which I find quite wrong to be honest.</p><p>Me too.</p></div>
<form><label>Your name</label><input name="n"><p>We never share your address with anybody else.</p></form></body>""",
    """<body><div class="cookie-notice">We use cookies to make this site work better for you. By going on you agree to our use of them.</div>
<div class="menu"><a href="/a">Start</a> <a href="/b">Recipes</a> <a href="/c">Contact</a></div>
<main><h1 data-keep>Bread with three ingredients</h1><p data-keep>Mix flour, water and salt, and leave the dough alone for a night in a cool place.</p>
<p data-keep>Bake it hot.</p><blockquote data-keep>Good bread needs time more than anything else, my grandmother used to say.</blockquote>
<pre data-keep>500 g flour, 350 g water, 10 g salt</pre></main>
<div class="sidebar"><h3>About the author</h3><p>Anna bakes and writes about it in her free time since she moved to the country.</p></div>
<div class="newsletter"><p>Sign up for our letter and never miss a recipe again.</p></div>
<footer><p>Imprint</p><p>This site is made with love and with a lot of butter in a small kitchen.</p></footer></body>""",
    """<body><div>Forum</div><div><a href="/l">Log in</a> | <a href="/r">Register</a></div>
<div><p data-keep>Our cat was missing for nine days in the winter, and we had given up hope when the phone rang in the evening.</p>
<p data-keep>A farmer two villages away had found her in his barn, thin but well, and had read the note on the board of the shop.</p>
<p data-keep>She has not left the garden since.</p></div>
<div><a href="/x">Next</a> <a href="/y">Previous</a></div><div>Powered by software</div></body>""",
    """<body><div role="banner"><span>Daily Science</span></div><div role="navigation"><a href="/p">Physics</a><a href="/q">Chemistry</a></div>
<section class="post"><h1 data-keep>New telescope sees first light</h1><div data-keep>After eleven years of work the telescope on the high plain has taken its first picture of the southern sky.</div>
<div data-keep>The team cheered.</div><div class="share">Share this with your friends</div>
<div data-keep>It will now be tested for half a year before astronomers can apply for nights of their own to look at whatever they choose.</div></section>
<div class="related"><h4>Related</h4><p>A star that should not be there puzzles the people who found it last summer.</p></div>
<div class="promo">Read all articles for one month for only one coin and stop whenever you like.</div></body>""",
    """<body><p class="breadcrumb"><a href="/">Start</a> &gt; <a href="/t">Travel</a></p><article><header><h1 data-keep>A week on foot</h1></header>
<p data-keep>We walked from the coast to the hills in seven days, with one rucksack each and no plan but the direction.</p>
<div class="advert">Cheap flights to the sun all through the winter, book until Sunday to save.</div>
<p data-keep>It rained twice.</p><p data-keep>On the last evening an old couple let us sleep in their barn, and we talked until the fire had gone out.</p></article>
<div id="disqus_thread"><p>What a lovely trip, we did the same some years ago with our children and it was a joy.</p></div></body>""",
    """<body><nav><a href="/">Home</a> <a href="/all">All</a></nav><article><h1 data-keep>Fog</h1><p data-keep>It came in.</p>
<p data-keep>Nobody saw the harbour for three days, and the boats stayed where they were with their lamps lit.</p><p data-keep>Silence.</p>
<p data-keep>Then it went.</p></article><footer>Harbour Gazette, printed daily at the old quay since nineteen hundred and four.</footer></body>""",
    """<body><div class="ad">New year, new kitchen, come and see us on the ring road.</div><main><h2 data-keep>Yes</h2><p data-keep>Yes.</p><p data-keep>No.</p>
<p data-keep>Perhaps they will decide tomorrow, said the chairman, and perhaps they will not decide at all this year.</p><p data-keep>Of.</p></main>
<footer>Imprint and contact</footer></body>""",
    """<body><ul><li><a href="/w">World</a></li><li><a href="/s">Sport</a></li></ul><article><p data-keep>See <a href="/full-story">the full story</a></p>
<p data-keep><a href="/source">A letter to the editor</a></p><p data-keep>The letter was read out at the meeting and met with long applause from the whole room.</p>
<p data-keep>End.</p></article><aside>Weather: sun</aside><div class="footer">Contact us</div></body>""",
    """<body><div>Small Town Blog</div><div><a href="/old">Older</a></div><div>Menu</div>
<p data-keep>The library opens again on the first of May, with longer hours and a new room for children under ten years.</p>
<p data-keep>Every book that is still at home from last year can be brought back without a fee until the end of the month.</p>
<div>Tags</div><div><a href="/t1">library</a>, <a href="/t2">town</a></div><div>Posted by admin</div><div>Back to top</div></body>""",
    """<body><div>Shop</div><div><a href="/cart">Cart</a></div><article><h1 data-keep>Notes</h1><p data-keep>Short.</p><p data-keep>Also short.</p></article><div>Top</div><div>Print</div></body>""",
    """<body><div><a href="/1">Home page</a> <a href="/2">All our articles</a> <a href="/3">About the whole team</a> <a href="/4">Contact</a></div>
<div><p data-keep>The mill by the river was built before anybody alive today was born, and it still grinds flour twice a week.</p>
<p data-keep>Visitors may watch, and <a href="/buy">buy a bag</a> of it on the way out through the yard.</p></div>
<div><a href="/5">Ten things to do in the valley this summer</a></div><div><a href="/6">Why the old road was closed again last week</a></div>
<div><a href="/7">What our readers liked best in the past year</a></div></body>""",
    """<body><table><tr><td><a href="/a">News from here</a> | <a href="/b">News from far away</a> | <a href="/c">Letters from our readers</a></td></tr></table>
<h1 data-keep>The last lamp lighter of the old town</h1><p data-keep>Every evening at dusk he takes his ladder and his pole and walks the same eleven streets as his father did.</p>
<p data-keep>There are forty-one gas lamps left in the old town, and he knows each of them by its number and by its sound.</p>
<p><a href="/d">Read the next story about the people of the old town here</a></p><p><a href="/e">Go back to the list of all stories of this month</a></p></body>""",
    """<article><h1 data-keep>Snow</h1><p data-keep>It fell all night and by the morning the fences were gone and the road was only a guess.</p><p data-keep>We stayed in.</p></article>""",
    """<html><body><main><p data-keep>First.</p><p data-keep>The first of anything is the hardest, the old man said, and he had done many things for the first time.""",
    """<p data-keep>A page may be nothing but a few paragraphs that somebody wrote down in a hurry many years ago.</p>
<p data-keep>Then there is no menu to leave out and no footer either, and all of the text has to stay as it is.</p>""",
    """<div>Top</div><article><p data-keep>One.</p><p data-keep>Two.</p><p data-keep>Three.</p></article><div>Bottom</div>""",
    """<div>Login</div><div>English</div><h1 data-keep>What the tide brings to the long beach in autumn</h1>
<p data-keep>After every storm the long beach is covered with wood, rope, bottles and now and then with something nobody can name.</p>
<div>Print page</div><div>Site map</div>""",
    """<body><div id="social-wrapper"><div>Club news</div><article><h1 data-keep>The club has a new home</h1>
<p data-keep>After thirty years in the old hall the club has moved to the former school at the end of the lane.</p>
<p data-keep>There is room for <a href="/chess">chess</a>, for cards and for a small kitchen, and the rent is lower than before.</p>
<p data-keep>Come in.</p></article></div><div><a href="/1">Next meeting</a> <a href="/2">All dates</a></div></body>""",
    """<body><div>Valley Post</div><main><h1 data-keep>Frost comes early to the orchards</h1><p data-keep>The apples were still on the trees when the first frost came, two weeks before anybody had thought of it.</p>
<p data-keep>Most of them can be saved, the growers say, if it does not snow before the end of the week and the ladders hold.</p><p data-keep>Pears are lost.</p></main>
<div class="sidebar"><article><h3>Old mill for sale</h3><p>The owner wants to see it in good hands and will not take the first offer.</p></article>
<article><h3>School play sold out</h3><p>There will be a second evening for everybody who has not got a ticket.</p></article></div></body>""",
    """<body class="page-with-menu"><div class="nav-wrapper"><main><h1 data-keep>A bench for the view</h1><p data-keep>Somebody has put a bench on the hill above the village, and nobody knows who it was or why.</p>
<p data-keep>It is a good bench.</p><p data-keep>From there the eye goes over the roofs and the river to the far side, where the trains go by without a sound.</p></main></div><div>Top</div></body>""",
    """<body><form id="page-form"><div><a href="/in">Sign in</a></div><main><h1 data-keep>Minutes of the meeting</h1><p data-keep>The chair opened the meeting at eight and thanked everybody who had come through the rain.</p>
<p data-keep>The accounts were read and agreed to without a vote, and the new roof will be paid for in three parts.</p><p data-keep>Closed at ten.</p></main></form></body>""",
    """<body><div><a href="/a">Politics</a></div><div>Sections</div><div><a href="/b">Money</a></div><div>More</div><div><a href="/c">Sport and games</a></div>
<p data-keep>A bridge that nobody wanted has become the most walked path of the town within a single summer.</p><p data-keep>Why?</p>
<p data-keep>It leads from the station straight to the water, and there is shade on it for most of the day.</p>
<div><a href="/d">How the bridge was paid for in the end</a></div><div>See also</div><div><a href="/e">Ten other bridges that people love</a></div></body>""",
    """<body><div><a href="/x">Front page of today</a></div><p data-keep>No.</p><p data-keep>That was all the minister had to say when she was asked whether the tax would go up again next year.</p>
<p data-keep>Later her office sent a letter of four pages that said much the same in many more words than that.</p><p data-keep>Not a word about the year after next.</p>
<div><a href="/y">Who pays and who does not</a></div><div>Latest</div><div><a href="/z">Rain expected for the whole of the weekend</a></div></body>""",
    """<body><div class="layout has-menu"><div class="content-sidebar-wrap"><article class="post no-comments"><div class="entry-header"><h1 data-keep>Two bells</h1></div>
<p data-keep>The tower has two bells again, after one of them had hung silent with a crack since the winter of the great cold.</p><p data-keep>They rang at noon.</p>
<div class="share-buttons">Tell a friend about this page</div><p data-keep>It took four men and a day and a half to bring the new one up, and a bottle was opened at the top.</p></article>
<div class="sidebar-widget"><h3>On this day</h3><p>A list of what happened here in other years on the same day of the month.</p></div></div></div></body>""",
    """<body><div role="main"><h2 data-keep>Lost and found</h2><p data-keep>A grey glove was found by the gate, and a key with a red band was left on the counter of the bakery.</p><p data-keep>Ask inside.</p></div>
<div role="complementary"><p>Opening hours are from nine to five, and from ten to two on the last day of the week.</p></div></body>""",
    """<body><div class="notice-board"><p>The site will be down for work on Sunday night between two and four in the morning.</p></div><article><p data-keep>He had sold shoes in the same shop for forty years and could tell by the step who was coming in.</p>
<p data-keep>Now the shop is closed, and he walks through the town and looks at the shoes of the people on the square.</p></article>
<div class="recommended"><article><h4>A shop that sells only hats</h4><p>The owner has never counted them and does not mean to start now.</p></article></div></body>""",
    """<body><div>Index</div><div><a href="/k">Older posts of this year</a></div><div>Search</div><h1 data-keep>Swifts</h1><p data-keep>They came back on the third of May, eleven of them, and screamed around the tower until it was dark.</p>
<p data-keep>They are late.</p><p data-keep>In some years they are here before the end of April, and in one year, long ago, they never came at all.</p><div>Share</div><div><a href="/l">Newer posts of this year</a></div></body>""",
]
