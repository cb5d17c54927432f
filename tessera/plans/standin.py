"""A model for the registered queries and tests, which have none: it shows that
prompts go out and answers come back, row by row."""

from __future__ import annotations

from tessera.operators.infer import CompleteFn


def extractive_answer_factory() -> CompleteFn:
    """Answers with the first sentence of the last non-empty paragraph of the
    prompt (ASCII whitespace rules), wrapped in ``<summary>`` tags."""
    import re

    ws = " \t\n\r\f\v"

    def fn(prompts: list[str]) -> list[str | None]:
        out = []
        for p in prompts:
            if p is None:
                out.append(None)
                continue
            paras = [x.strip(ws) for x in re.split(r"\n\s*\n", p, flags=re.ASCII) if x.strip(ws)]
            last = paras[-1] if paras else ""
            first = re.split(r"(?<=[.!?])\s+", last, maxsplit=1, flags=re.ASCII)[0]
            out.append(f"<analysis>extractive</analysis>\n<summary>\n{first}\n</summary>")
        return out
    return fn


def failing_answer_factory() -> CompleteFn:
    """The same, but it raises where a prompt's number of characters is a multiple of 3."""
    answer = extractive_answer_factory()

    def fn(prompts: list[str]) -> list[str | None]:
        if any(len(p) % 3 == 0 for p in prompts):
            raise RuntimeError("the model is not available")
        return answer(prompts)
    return fn


def broken_answer_factory() -> CompleteFn:
    """A model that always raises."""
    def fn(prompts: list[str]) -> list[str | None]:
        raise RuntimeError("the model is not available")
    return fn


def extractive_chat_factory():
    """The same as a chat model: it answers the request's last part of text, says
    how many messages it saw and how long its answer is, and raises for
    requests whose last text has a number of characters that 5 divides."""
    answer = extractive_answer_factory()

    def fn(requests: list[dict]) -> list[dict]:
        texts = [[p["text"] for p in r["parts"] if p["kind"] == "TEXT"][-1] for r in requests]
        if any(len(t) % 5 == 0 for t in texts):
            raise RuntimeError("the model is not available")
        return [{"content": a, "input_tokens": len(r["messages"]), "output_tokens": len(a), "finish_reason": "STOP"}
                for a, r in zip(answer(texts), requests)]
    return fn
