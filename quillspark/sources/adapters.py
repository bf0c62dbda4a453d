"""Optional adapters for remote services: a chat endpoint and GET lookups. Keys come from the environment.

Adapters are picklable callables for ``review.ask``, ``feedback.judge`` and ``geneids.resolve_ids``; none is on the path of a query.
"""

from __future__ import annotations

import http.client
import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from dataclasses import dataclass, replace


@dataclass(frozen=True)
class ChatReviewer:
    """A chat-completion endpoint: returns the answer's text; None if no try gave one that holds JSON.

    A refused key (401) raises PermissionError at once. 429 waits ``wait`` seconds times the number of tries, anything else ``pause``.
    """

    url: str
    model: str
    key_variable: str = "LLM_API_KEY"
    timeout: float = 60
    wait: float = 5
    pause: float = 2
    between: float = 0.1
    tries: int = 3
    max_tokens: int = 2500

    def single(self) -> ChatReviewer:
        """The same endpoint for one pair at a time: shorter waits and answers."""
        return replace(self, timeout=self.timeout / 2, wait=3, pause=1, between=0.3, max_tokens=300)

    def __call__(self, prompt: str) -> str | None:
        body = {"model": self.model, "messages": [{"role": "user", "content": prompt}], "temperature": 0.1, "max_tokens": self.max_tokens}
        headers = {"Authorization": f"Bearer {os.environ[self.key_variable]}", "Content-Type": "application/json"}
        for attempt in range(1, self.tries + 1):
            rest = self.pause
            try:
                request = urllib.request.Request(self.url, json.dumps(body).encode(), headers)
                with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                    text = json.load(answer)["choices"][0]["message"]["content"]
                json.loads(plain(text))
                time.sleep(self.between)
                return text
            except urllib.error.HTTPError as error:
                if error.code == 401:
                    raise PermissionError("the key was refused") from error
                rest = self.wait * attempt if error.code == 429 else self.pause
            except (OSError, ValueError, KeyError, IndexError, TypeError, http.client.HTTPException):
                pass  # cut-off answers are tried again like all others
            if attempt < self.tries:
                time.sleep(rest)
        return None


def plain(answer: str) -> str:
    """An answer without a code fence."""
    return answer.split("```")[1].removeprefix("json").strip() if "```" in answer else answer.strip()


@dataclass(frozen=True)
class HttpLookup:
    """A GET endpoint: the answer's text for the formatted address, None if it fails. ``pause`` seconds follow each call."""

    address: str
    encoding: str = "utf-8"
    timeout: float = 15
    pause: float = 0.3

    def __call__(self, term: str) -> str | None:
        try:
            request = urllib.request.Request(self.address.format(urllib.parse.quote(term)), headers={"User-Agent": "Mozilla/5.0"})
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                return answer.read().decode(self.encoding, "replace")
        except (OSError, http.client.HTTPException):
            return None
        finally:
            time.sleep(self.pause)
