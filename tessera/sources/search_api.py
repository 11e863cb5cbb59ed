"""A live search provider: a generative interface that answers from a web search, over HTTP."""

from __future__ import annotations

import json
import urllib.request

from tessera.operators.search import Answer, InvalidResponse


class HttpProvider:
    """Asks `{url}/models/{model}:generateContent` with the search tool on, and reads text and grounding of the first candidate.

    HTTP errors pass through with their status as `code`, so passing trouble is tried again by the searcher.
    """

    def __init__(self, config, timeout: float = 120.0):
        self.config, self.timeout = config, timeout

    def ask(self, prompt: str, entities: list[dict]) -> Answer:
        c = self.config
        body = {
            "contents": [{"role": "user", "parts": [{"text": prompt}]}],
            "tools": [{"google_search": {}}],
            "generationConfig": {"temperature": c.llm_temperature, "maxOutputTokens": c.llm_max_tokens},
        }
        request = urllib.request.Request(f"{c.llm_url.rstrip('/')}/models/{c.llm_model}:generateContent", json.dumps(body).encode(), {"Content-Type": "application/json", "x-goog-api-key": c.llm_key})
        with urllib.request.urlopen(request, timeout=self.timeout) as answer:
            return answer_of(json.loads(answer.read()))


def answer_of(payload: dict) -> Answer:
    """Text, queries and source addresses of a response; all candidates' grounding counts."""
    candidates = payload.get("candidates") if isinstance(payload, dict) else None
    if not isinstance(candidates, list) or not candidates:
        raise InvalidResponse("the response holds no candidate")
    text = "".join(part.get("text") or "" for part in (candidates[0].get("content") or {}).get("parts") or [])
    grounding = [c.get("groundingMetadata") or {} for c in candidates]
    return Answer(
        text,
        any(g.get("searchEntryPoint") for g in grounding),
        [q for g in grounding for q in g.get("webSearchQueries") or []],
        [uri for g in grounding for chunk in g.get("groundingChunks") or [] if (uri := (chunk.get("web") or {}).get("uri"))],
    )
