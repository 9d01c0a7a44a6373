"""Hand-labelled page layouts for the content model: `main` marks an element whose text, with all below it, is main
text, `not` one inside it that is not. `{s}`, `{m}` and `{l}` stand for a few words, a sentence and a paragraph."""

LAYOUTS = [
    """<html><head><title>{s}</title></head><body><header class="site-header"><a href="/">{s}</a><p>{m}</p></header>
    <nav class="main-nav"><ul><li><a href="/">{s}</a></li><li><a href="/">{s}</a></li><li><a href="/">{s}</a></li></ul></nav>
    <main main><h1>{s}</h1><p>{m}</p><p>{l}</p><h2>{s}</h2><p>{l}</p><ul><li>{m}</li><li>{s}</li></ul><p>{l}</p>
    <div not class="ad">{m}</div><p>{m}</p></main><aside class="sidebar"><h3>{s}</h3><p>{m}</p><ul><li><a href="/">{s}</a></li></ul></aside>
    <footer><p>{m}</p><p>{s}</p></footer></body></html>""",
    """<html><body><div id="header"><div class="logo">{s}</div><div class="menu"><a href="/">{s}</a> <a href="/">{s}</a></div></div>
    <div class="cookie-notice banner"><p>{m}</p><button>{s}</button></div><div id="content" main><h1>{s}</h1><p>{l}</p><p>{m}</p>
    <blockquote>{m}</blockquote><p>{l}</p><div not class="share social">{s}</div><div not class="related"><h3>{s}</h3><ul><li><a href="/">{s}</a></li>
    <li><a href="/">{s}</a></li></ul></div></div><div id="comments" class="comments"><h3>{s}</h3><div class="comment"><p>{l}</p></div>
    <div class="comment"><p>{m}</p></div></div><div id="footer">{m}</div></body></html>""",
    """<html><body><div class="wrapper"><div class="top-bar"><span>{s}</span></div><div class="breadcrumb"><a href="/">{s}</a> {s}</div>
    <article main class="post entry"><h1 class="title">{s}</h1><p>{l}</p><p>{l}</p><figure><figcaption>{m}</figcaption></figure><p>{m}</p>
    <form not class="newsletter subscribe"><p>{m}</p><label>{s}</label></form><aside not class="promo"><p>{m}</p></aside><p>{l}</p>
    <section not class="comments"><h2>{s}</h2><ol><li><p>{m}</p></li><li><p>{l}</p></li></ol></section></article>
    <div class="widget sidebar"><h4>{s}</h4><p>{m}</p></div></div><footer class="site-footer"><ul><li><a href="/">{s}</a></li></ul><p>{s}</p></footer></body></html>""",
    """<html><body main><h1>{s}</h1><p>{m}</p><p>{l}</p><p>{l}</p><h2>{s}</h2><p>{m}</p></body></html>""",
    """<html><body><table><tr><td class="nav menu"><a href="/">{s}</a><p><a href="/">{s}</a></p></td><td main class="main text"><h1>{s}</h1>
    <p>{l}</p><p>{m}</p><p>{l}</p></td><td class="right sidebar"><p>{m}</p><p><a href="/">{s}</a></p></td></tr></table>
    <div class="copyright footer">{s}</div></body></html>""",
    """<html><body><div class="notice alert warning"><p>{m}</p></div><div class="page container"><div class="navigation"><ul><li><a href="/">{s}</a></li>
    <li><a href="/">{s}</a></li></ul></div><div main class="article-body story"><h1>{s}</h1><div class="paragraph">{l}</div><div class="paragraph">{m}</div>
    <div not class="advert sponsored banner">{m}</div><p>{l}</p></div><div class="login search"><form><p>{s}</p><label>{m}</label></form></div>
    <div class="replies reviews responses"><div class="reply"><p>{m}</p></div><div class="reply"><p>{l}</p></div></div></div>
    <div class="bottom legal privacy"><p>{m}</p></div></body></html>""",
    """<html><body><section class="hero masthead"><p>{s}</p></section><section main class="post-content"><h2>{s}</h2><p>{l}</p><p>{s}</p><p>{l}</p>
    <pre>{m}</pre><table><tr><th>{s}</th><td>{m}</td></tr></table><p>{m}</p></section><section class="tags categories"><a href="/">{s}</a>
    <a href="/">{s}</a></section><section class="popup modal overlay"><p>{m}</p></section><section class="ads"><p>{m}</p></section>
    <div class="author-bio"><p>{m}</p></div><div class="pagination"><a href="/">{s}</a></div><footer>{m}</footer></body></html>""",
    """<html><body><div class="skip"><a href="/">{s}</a></div><div role="banner"><p>{m}</p></div><div role="navigation"><ul><li><a href="/">{s}</a></li></ul></div>
    <div main role="main"><p>{l}</p><p>{m}</p><dl><dt>{s}</dt><dd>{m}</dd></dl><p>{l}</p><div not class="toc contents"><ul><li><a href="/">{s}</a></li>
    <li><a href="/">{s}</a></li></ul></div></div><div role="complementary"><p>{m}</p></div><div id="disqus_thread" class="discussion feedback">
    <p>{m}</p><p>{l}</p></div><div role="contentinfo"><p>{s}</p></div></body></html>""",
    """<html><body><div class="container"><ul class="menu links"><li><a href="/">{s}</a></li><li><a href="/">{s}</a></li><li><a href="/">{s}</a></li></ul>
    <div main class="content"><h1>{s}</h1><ul><li>{m}</li><li>{l}</li><li>{s}</li></ul><p>{m}</p><ol><li>{m}</li><li><p>{l}</p></li></ol>
    <table><thead><tr><th>{s}</th><th>{s}</th></tr></thead><tbody><tr><td>{s}</td><td>{m}</td></tr><tr><td>{s}</td><td>{s}</td></tr></tbody></table>
    <dl><dt>{s}</dt><dd>{m}</dd></dl><div><p>{l}</p></div><div>{m}</div></div><div class="user-comments"><ul><li>{m}</li><li>{l}</li></ul></div>
    <div class="side column"><ul><li>{s}</li></ul><p>{m}</p></div></div><div class="foot"><p>{s}</p></div></body></html>""",
    """<html><body><header><nav><ul><li><a href="/">{s}</a></li></ul></nav></header><main main><article><h1>{s}</h1><div>{m}</div><div><div>{l}</div></div>
    <p>{l}</p><section><h2>{s}</h2><p>{l}</p><div>{s}</div></section><div not class="notice"><p>{m}</p></div><nav not><ul><li><a href="/">{s}</a></li></ul></nav>
    <section not class="comments"><h2>{s}</h2><div><p>{l}</p></div><div><p>{m}</p></div></section><footer not><p>{m}</p></footer></article>
    <section not id="comments"><h3>{s}</h3><div class="comment"><p>{l}</p><p>{m}</p></div></section><div not class="comment-list"><p>{l}</p></div></main>
    <div class="ad"><p>{m}</p></div><aside><div><p>{m}</p></div></aside><form><p>{s}</p><fieldset><legend>{s}</legend><p>{m}</p></fieldset></form></body></html>""",
]

#: What the marks in a layout become: lengths like those of real headings, sentences and paragraphs.
FILLERS = {"s": ["Lorem", "Dolor sit", "Amet consectetur elit", "Sed do eiusmod tempor."],
           "m": ["Ut enim ad minim veniam, quis nostrud exercitation.", "Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu.",
                 "Excepteur sint."],
           "l": ["Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium. " * 2,
                 "Nemo enim ipsam voluptatem quia voluptas sit aspernatur aut odit aut fugit, sed quia consequuntur magni. " * 5]}
