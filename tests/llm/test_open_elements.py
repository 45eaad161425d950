"""Elements whose end tag is left out do not take the rest of the page with them."""

from targetlens.llm.html_blocks import leaf_blocks


def texts(page):
    return [b.text.strip() for b in leaf_blocks(page) if b.text.strip()]


def test_head_without_end():
    assert texts("<head><title>x</title><body><article><p>One two.</p></article>") == ["One two."]
    assert texts("<html><head><script>if (a<b) { '<div>' }</script><p>late</p>") == ["late"]


def test_open_containers_lose_their_tag_only():
    for name in ("noscript", "template", "select", "object", "canvas"):
        assert texts(f"<p>before</p><{name}><div>Main text</div><p>more</p>") == ["before", "Main text", "more"]
        assert texts(f"<p>before</p><{name}>gone</{name}><p>more</p>") == ["before", "more"]


def test_open_raw_text_ends_with_the_page():
    for name in ("script", "style", "title", "textarea"):
        assert texts(f"<p>before</p><{name}><p>not text</p>") == ["before"]
