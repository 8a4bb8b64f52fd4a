"""What generators must answer: closed records, checked field by field. A record is a plain dict."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field


class ContractError(ValueError):
    pass


Check = Callable[[object, str], object]


def text(value, at: str):
    if not isinstance(value, str) or not value.strip():
        raise ContractError(f"{at}: a text that is not blank is needed")
    return value


def optional(check: Check) -> Check:
    return lambda value, at: None if value is None else check(value, at)


def whole(least: int, most: int) -> Check:
    def check(value, at):
        if isinstance(value, bool) or not isinstance(value, int) or not least <= value <= most:
            raise ContractError(f"{at}: a whole number from {least} to {most} is needed")
        return value

    return check


def one_of(*names: str) -> Check:
    def check(value, at):
        if value not in names:
            raise ContractError(f"{at}: one of {', '.join(names)} is needed")
        return value

    return check


def many(check: Check, *, least: int = 0, unique: Callable | None = None) -> Check:
    def checked(value, at):
        if not isinstance(value, (list, tuple)) or len(value) < least:
            raise ContractError(f"{at}: a list of at least {least} is needed")
        out = [check(v, f"{at}[{k}]") for k, v in enumerate(value)]
        if unique and len({unique(v) for v in out}) < len(out):
            raise ContractError(f"{at}: entries must differ")
        return out

    return checked


@dataclass(frozen=True)
class Contract:
    """A closed record: fields by name, defaults of those that may be left out, other names of fields, and a check of the whole."""

    name: str
    fields: dict[str, Check]
    defaults: dict[str, object] = field(default_factory=dict)
    aliases: dict[str, tuple[str, ...]] = field(default_factory=dict)
    whole: Callable | None = None

    def __call__(self, value, at: str = "") -> dict:
        at = at or self.name
        if not isinstance(value, dict):
            raise ContractError(f"{at}: a record is needed")
        value = dict(value)
        for name, others in self.aliases.items():
            for other in others:
                if other in value and name not in value:
                    value[name] = value.pop(other)
        unknown = sorted(set(value) - set(self.fields))
        if unknown:
            raise ContractError(f"{at}: unknown fields {', '.join(unknown)}")
        out = {}
        for name, check in self.fields.items():
            if name not in value and name not in self.defaults:
                raise ContractError(f"{at}.{name}: missing")
            out[name] = check(value.get(name, self.defaults.get(name)), f"{at}.{name}")
        if self.whole:
            self.whole(out, at)
        return out


REFERENCE = Contract("reference", {"doc_id": text, "evidence_ids": many(text, least=1, unique=lambda x: x)})
TOPIC = Contract("topic", {"topic": text, "summary": text, "evidence": many(REFERENCE, least=1)})
FACT = Contract("fact", {"claim": text, "evidence": many(REFERENCE, least=1)})
DIGEST = Contract("digest", {"doc_id": text, "summary": text, "topics": many(TOPIC), "key_facts": many(FACT)}, {"topics": [], "key_facts": []})
REQUIREMENTS = Contract(
    "requirements",
    {"goal": text, "audience": text, "target_slide_count": whole(1, 100), "tone": optional(text), "presentation_type": optional(text), "must_include": many(text), "must_avoid": many(text)},
    {"tone": None, "presentation_type": None, "must_include": [], "must_avoid": []},
)
SELECTED = Contract("selected", {"doc_id": text, "evidence_id": text, "reason": text})
SELECTION = Contract(
    "selection",
    {"selected": many(SELECTED, least=1, unique=lambda x: (x["doc_id"], x["evidence_id"])), "strategy": optional(text)},
    {"strategy": None},
    {"selected": ("selected_evidence", "items", "selections")},
)
#: Purposes of slides, those that need evidence, and forms of content.
PURPOSES, CITING, FORMS = ("title", "section", "content", "summary"), ("content", "summary"), ("text", "list", "table", "chart", "image", "mixed")
SLIDE = Contract(
    "slide",
    {"slide_id": text, "title": text, "purpose": one_of(*PURPOSES), "message": text, "content_requirements": many(text), "evidence": many(REFERENCE), "preferred_content_forms": many(one_of(*FORMS))},
    {"content_requirements": [], "evidence": [], "preferred_content_forms": []},
)
SECTION = Contract("section", {"section_id": text, "title": text, "purpose": text, "slides": many(SLIDE, least=1)})


def _slides_differ(outline: dict, at: str) -> None:
    names = [s["slide_id"] for s in slides(outline)]
    if len(set(names)) < len(names):
        raise ContractError(f"{at}: slide ids must differ")


OUTLINE = Contract("outline", {"schema_version": text, "title": text, "objective": text, "narrative": text, "sections": many(SECTION, least=1)}, {"schema_version": "1.0.0"}, whole=_slides_differ)
ARTIFACT = Contract("artifact", {"doc_id": text, "filename": text, "artifact_uri": text, "health": optional(one_of("ready", "degraded"))}, {"health": None})
MANIFEST = Contract("manifest", {"schema_version": text, "corpus_id": text, "documents": many(ARTIFACT, unique=lambda x: x["doc_id"])}, {"schema_version": "1.0.0", "documents": []})
CLASSIFICATION = Contract(
    "classification",
    {"asset_id": text, "asset_sha256": text, "classifier_version": text, "prompt_version": text, "relevance": text, "decorative": one_of(True, False), "description": optional(text), "likely_caption": optional(text), "confidence": lambda v, at: v, "error": optional(text)},
    {"description": None, "likely_caption": None, "confidence": None, "error": None},
)


def slides(outline: dict) -> list[dict]:
    """Slides in the order they were written."""
    return [s for section in outline["sections"] for s in section["slides"]]


def digest_references(digest: dict) -> list[dict]:
    return [r for part in (*digest["topics"], *digest["key_facts"]) for r in part["evidence"]]
