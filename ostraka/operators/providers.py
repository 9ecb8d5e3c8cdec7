"""Registry of embedding providers: the first that accepts an address serves it."""

from __future__ import annotations

import json
import math
import urllib.request
from collections.abc import Callable, Sequence
from typing import ClassVar
from urllib.parse import quote, urlsplit, urlunsplit

from ostraka.operators.embeddings import hash_embedder


class Provider:
    """A source of vectors. Subclasses are tried in the order of their definition."""

    registered: ClassVar[list[type[Provider]]] = []

    def __init_subclass__(cls, register: bool = True, **kwargs):
        super().__init_subclass__(**kwargs)
        if register:
            Provider.registered.append(cls)

    @classmethod
    def initialize(cls, address: str, model: str, key: str | None) -> Provider | None:
        raise NotImplementedError

    def embed(self, texts: Sequence[str]) -> list:
        raise NotImplementedError


class CheckedProvider(Provider, register=False):
    """Vectors of a callable, which must be finite and of the dimension that the first one had."""

    def __init__(self, call: Callable[[list[str]], list], context_tokens: int | None = None, count: Callable[[str], int] = lambda t: math.ceil(len(t.encode()) / 3)):
        self.call, self.context_tokens, self.count, self.dims = call, context_tokens, count, None

    def embed(self, texts: Sequence[str]) -> list:
        fits = [i for i, t in enumerate(texts) if self.context_tokens is None or self.count(t) <= self.context_tokens]
        out: list = [None] * len(texts)
        for i, vector in zip(fits, self.call([texts[i] for i in fits]) if fits else ()):
            if not len(vector) or any(not math.isfinite(x) for x in vector):
                raise ValueError("a vector is empty or isn't finite")
            if self.dims is None:
                self.dims = len(vector)
            if len(vector) != self.dims:
                raise ValueError(f"the dimension changed from {self.dims} to {len(vector)}")
            out[i] = vector
        return out


class HashProvider(CheckedProvider):
    """The stand-in that needs no network, at addresses of the scheme ``hash:<dims>``."""

    @classmethod
    def initialize(cls, address: str, model: str, key: str | None) -> Provider | None:
        scheme, _, dims = address.partition(":")
        return cls(hash_embedder(int(dims or 16))) if scheme == "hash" else None


Transport = Callable[[str, str, dict | None, dict], dict]
TIMEOUT_S = 60


def http_json(method: str, address: str, body: dict | None, headers: dict) -> dict:
    """One request with a JSON body and a JSON object as its answer."""
    data = None if body is None else json.dumps(body).encode()
    request = urllib.request.Request(address, data=data, method=method, headers={"Content-Type": "application/json", **headers})
    with urllib.request.urlopen(request, timeout=TIMEOUT_S) as answer:
        return json.loads(answer.read())


def _whole(payload: object, *path: str, least: int = 0) -> int:
    """A count in an answer, at a path of names."""
    for name in path:
        payload = payload.get(name) if isinstance(payload, dict) else None
    if not isinstance(payload, int) or isinstance(payload, bool) or payload < least:
        raise ValueError(f"the answer has no valid {'.'.join(path)}")
    return payload


class RemoteProvider(CheckedProvider, register=False):
    """A service that answers ``POST <base>/embeddings`` with one vector and the tokens of the text.

    Subclasses say at which host it is, where the tokens are told, and how long a text may be. The
    transport can be replaced, so that nothing but this shape needs a network.
    """

    transport: ClassVar[Transport] = staticmethod(http_json)
    host: ClassVar[str] = ""
    usage: ClassVar[str] = "prompt_tokens"
    context: ClassVar[int | None] = None

    def __init__(self, base: str, model: str, key: str | None):
        super().__init__(lambda texts: [self.embedded(t)[0] for t in texts], None)
        self.base, self.model, self.key = base, model, key
        self.context_tokens = self.context

    @classmethod
    def initialize(cls, address: str, model: str, key: str | None) -> Provider | None:
        parts = urlsplit(address)
        return cls(base_address(address), model, key) if (parts.hostname or "").rstrip(".").lower() == cls.host else None

    def ask(self, method: str, path: str, body: dict | None = None) -> dict:
        answer = type(self).transport(method, self.base + path, body, {"Authorization": f"Bearer {self.key}"} if self.key else {})
        if not isinstance(answer, dict):
            raise ValueError(f"the answer isn't an object: {error_summary(answer)}")
        return answer

    def embedded(self, text: str) -> tuple[list[float], int]:
        answer = self.ask("POST", "/embeddings", {"model": self.model, "input": text})
        try:
            vector = [float(x) for x in answer["data"][0]["embedding"]]
        except (KeyError, IndexError, TypeError, ValueError) as error:
            raise ValueError(f"the answer has no vector: {error_summary(answer)}") from error
        return vector, _whole(answer, "usage", self.usage)

    def token_count(self, text: str) -> int:
        return self.embedded(text)[1]

    def context_length(self) -> int:
        return self.context_tokens

    def embedding_length(self) -> int:
        if self.dims is None:
            self.embed(["test"])
        return self.dims


# Hosts, names of counts and context lengths of the services.
class MistralProvider(RemoteProvider):
    host = "api.mistral.ai"

    def context_length(self) -> int:
        if self.context_tokens is None:
            self.context_tokens = _whole(self.ask("GET", f"/models/{quote(self.model, safe='')}"), "max_context_length", least=1)
        return self.context_tokens


class OpenAIProvider(RemoteProvider):
    host, context = "api.openai.com", 8192


class VoyageProvider(RemoteProvider):
    host, usage, context = "api.voyageai.com", "total_tokens", 32000


class LocalServerProvider(RemoteProvider):
    """A server of one's own, told by its answer at /version; it counts tokens without embedding."""

    @classmethod
    def initialize(cls, address: str, model: str, key: str | None) -> Provider | None:
        if urlsplit(address).scheme not in ("http", "https"):
            return None
        found = cls(address.rstrip("/").removesuffix("/v1"), model, key)
        try:
            return found if isinstance(found.ask("GET", "/version").get("version"), str) else None
        except (OSError, ValueError):
            return None

    def embedded(self, text: str) -> tuple[list[float], int]:
        answer = self.ask("POST", "/v1/embeddings", {"model": self.model, "input": text})
        try:
            return [float(x) for x in answer["data"][0]["embedding"]], 0
        except (KeyError, IndexError, TypeError, ValueError) as error:
            raise ValueError(f"the answer has no vector: {error_summary(answer)}") from error

    def token_count(self, text: str) -> int:
        answer = self.ask("POST", "/tokenize", {"model": self.model, "prompt": text})
        self.context_tokens = _whole(answer, "max_model_len", least=1)
        return _whole(answer, "count")

    def context_length(self) -> int:
        if self.context_tokens is None:
            self.token_count("")
        return self.context_tokens


def provider_for(address: str, model: str, key: str | None = None) -> Provider:
    for kind in Provider.registered:
        found = kind.initialize(address, model, key)
        if found is not None:
            return found
    raise ValueError(f"no provider serves {address!r}")


def base_address(address: str, version: str = "v1") -> str:
    """An address that ends with the version of the interface, without query and fragment."""
    parts = urlsplit(address)
    if parts.scheme not in ("http", "https") or not parts.netloc:
        raise ValueError(f"not an address: {address!r}")
    path = parts.path.rstrip("/")
    return urlunsplit((parts.scheme, parts.netloc, path if path.endswith(f"/{version}") else f"{path}/{version}", "", ""))


def error_summary(payload: object) -> str:
    """What an interface said of an error: message, type, parameter and code, as far as there."""
    error = payload.get("error", payload) if isinstance(payload, dict) else payload
    if not isinstance(error, dict):
        return str(error)
    return "; ".join(f"{k}: {error[k]}" if k != "message" else str(error[k]) for k in ("message", "type", "param", "code") if error.get(k) not in (None, ""))
