"""Only what an added page changes in a wrapper is weighed again."""

from stationcast.llm import html_extraction
from stationcast.llm.dom import TEXT, Shape


def page(*texts):
    root = Shape("html")
    for k, text in enumerate(texts):
        p = Shape(f"p.{k}")
        p.children.append(Shape(TEXT, text))
        root.children.append(p)
    return root.seal()


def test_only_what_changes_in_a_wrapper_is_weighed_again(monkeypatch):
    weighed = []
    weigh = html_extraction.weigh
    monkeypatch.setattr(html_extraction, "weigh", lambda nodes: (weighed.extend(nodes), weigh(nodes))[1])
    wrapper = html_extraction.Wrapper(page(*range(50)))
    wrapper.add(page(*range(49), 99))
    wrapper.add(page(*range(49), 99))
    assert wrapper.root.children[49].children[0].text == 99
    wrapper.add(page(*range(50), 7))
    assert len(weighed) <= 9
    keys = [(x.key, x.size, x.plain) for x in wrapper.root.nodes()]
    assert keys == [(x.key, x.size, x.plain) for x in wrapper.root.seal().nodes()]
    assert len(wrapper.root.children) == 51
