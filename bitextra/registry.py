"""Named components: the building blocks that job specs refer to by name."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field


class UnknownComponent(ValueError):
    pass


class DuplicateComponent(ValueError):
    pass


@dataclass
class Registry:
    """A kind of component ("cleaner", "preprocessor", ...) keyed by name."""

    kind: str
    _items: dict[str, Callable] = field(default_factory=dict)
    _about: dict[str, str] = field(default_factory=dict)

    def __call__(self, name: str, description: str = "") -> Callable[[Callable], Callable]:
        def add(fn: Callable) -> Callable:
            if name in self._items:
                raise DuplicateComponent(f"{self.kind} '{name}' is already registered")
            self._items[name] = fn
            self._about[name] = description
            return fn

        return add

    def get(self, name: str) -> Callable:
        if name not in self._items:
            known = ", ".join(sorted(self._items)) or "none"
            raise UnknownComponent(f"unknown {self.kind} '{name}'; available: {known}")
        return self._items[name]

    def __contains__(self, name: str) -> bool:
        return name in self._items

    def names(self) -> list[str]:
        return list(self._items)

    def describe(self) -> dict[str, str]:
        return dict(self._about)


loaders = Registry("loader")
cleaners = Registry("cleaner")
preprocessors = Registry("preprocessor")
augmenters = Registry("augmenter")
evaluators = Registry("evaluator")
tokenizers = Registry("tokenizer")

ALL = {r.kind: r for r in (loaders, cleaners, preprocessors, augmenters, evaluators, tokenizers)}
