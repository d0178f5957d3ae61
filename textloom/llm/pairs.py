"""Broken prompt and response pairs: what each answer is useless for.

Every message is read once, in a map, into a few small features (is it a filler, does it only decline, how does it end,
which languages, its words as numbers). Runs of one role are numbered by windows over those, questions and answers meet by
number, and words are fetched only for the few pairs that may be copies. Rules apply in order - emptiness, unclosed
delimiters and abrupt endings, refusal, copied question, other language - and every one that holds is reported.

Whether an ending without a terminator is abrupt is judged against the corpus: the last three words of the text are
abrupt unless a sentence ends there in ENDS or more of all the places where these words stand in one sentence. It is a
share, so it does not drift with the size of the table.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.functions.words import lcs_length, words
from textloom.llm import langid
from textloom.operators import turns
from textloom.session import materialize, ship

BLOCK = 4096  # turn numbers of a window partition
COPIED = 0.8  # share of an answer's words that stand in the question, said once or several times over, in the same order
ENDS = 0.15  # share of the places of three words at which a sentence must end
SLOT_BITS = 22  # the map of the endings that are asked for has 2 ** SLOT_BITS bits, however many there are
ROWS = 2_500  # rows that a task turns into features at a time
SENTENCES = 20_000  # sentences that a task remembers, about 15 MB

# Declining, in words without accents or punctuation
_REFUSAL = re.compile(
    r"\b(?:(?:can ?not|can t|cant|could not|couldn t|won t be able to|will not be able to|not able to|unable to|am not going to|won t|will not|do not wish to|don t wish to) "
    r"(?:be )?(?:help(?:ing)?|assist(?:ing)?|answer(?:ing)?|respond(?:ing)?|reply(?:ing)?|provid(?:e|ing)|shar(?:e|ing)|comment(?:ing)?|discuss(?:ing)?|tak(?:e|ing) this|talk(?:ing)? about|address(?:ing)?|fulfil+|comply)"
    r"|(?:must|have to|need to|ll have to|going to) (?:decline|refuse|pass on|leave (?:this|that|it|your \w+) unanswered)|decline to (?:answer|respond|comment|discuss)"
    r"|(?:rather not|prefer not to) (?:go into|discuss|answer|talk|say|comment|reply|respond)|(?:not|never) (?:permitted|allowed) to|(?:do|does|did) not (?:permit|allow) me|don t (?:permit|allow) me|outside what i|beyond what i"
    r"|not something i can|not (?:feel )?comfortable (?:with|replying|answering|discussing|responding|talking)|not (?:be )?appropriate for me|told not to|not possible for me to|have no answer for you|against (?:my|our) (?:polic|guideline|rule)|no comment|not at liberty|leave this unanswered)"
    r"|\bno (?:le |les |te |os )?(?:puedo|podemos|podria) (?:ayudar|dar|responder|contestar|hablar|comentar|facilitar|compartir|atender)|\bno (?:me|nos) (?:esta|es) (?:permitid|posible)|\bprefiero no|\bno estoy autorizad|\bno tengo permi|\b(?:debo|tengo que) (?:declinar|rechazar|negarme)|\bno quiero hablar"
    r"|\bne (?:peux|pouvons|puis|pourrai) (?:pas )?(?:vous |t |te )?(?:aider|repondre|donner|fournir|parler|commenter|partager|traiter)|\bpas le droit de|\bprefere ne pas|\bimpossible de (?:vous )?(?:parler|repondre|aider|commenter|donner)|\bpas autorise|\b(?:dois|refuse de) (?:decliner|refuser|repondre|parler)"
    r"|\bdarf ich (?:leider )?(?:nicht|keine)|\b(?:mochte|will) ich (?:lieber |leider )?(?:nicht|nichts)|\bkeine (?:auskunft|antwort|angaben machen)|\b(?:kann|konnen|darf) (?:ich |wir |ihnen |dir |leider |dabei |damit |dazu |hier |das |diese \w+ )*(?:nicht|nichts) (?:helfen|beantworten|sagen|weiterhelfen|dienen|antworten|besprechen)|\bmuss (?:ich )?(?:\w+ )?ablehnen"
    r"|मदद नहीं कर सकत|(?:जवाब|उत्तर) (?:नहीं दे सकत|देने की)|अनुमति नहीं|कुछ नहीं (?:बता|कह) सकत|बात नहीं कर|चर्चा नहीं|बताने में असमर्थ|मना कर"
    r"|உதவ (?:முடியாது|இயலாது|முடியவில்லை)|அனுமதி (?:இல்லை|கிடையாது)|பேச (?:விரும்பவில்லை|முடியாது|இயலாது|விரும்பல)|(?:சொல்ல|கூற) (?:இயலாது|முடியாது|விரும்பவில்லை)|பதிலளிக்க (?:முடியாது|இயலாது)|பதில் (?:சொல்ல|அளிக்க|தர) (?:முடியாது|இயலாது)"
    r"|(?:help|share|answer|reply|comment|discuss) பண்ண (?:முடியாது|முடியல|இயலாது|மாட்டேன்)|permission (?:இல்ல|கிடையாது)|(?:answer|பதில்) (?:சொல்ல|தர) (?:முடியாது|permission)"
)
# Words of courtesy around it that help with nothing
_COURTESY = re.compile(
    r"^(?:(?:hello|hi|hey|dear \w+|good (?:morning|day|evening)|thanks?(?: you)?(?: very much| so much)?(?: for (?:writing|asking|your \w+|reaching out|the \w+|getting in touch|contacting us))?|sorry|my apologies|apologies|i understand\b.*|i (?:am|m) sorry|regrettably|unfortunately|i hope you understand|"
    r"(?:but )?(?:please )?(?:do )?(?:ask about something else|ask (?:me )?something else|turn to .{1,40} instead|contact .{1,40} instead|consult .{1,40}|speak to .{1,40})|is there anything else.*|have a (?:nice|good) day|take care|all the best|"
    r"hola|gracias(?: por \w+)?|lo siento|disculpe?|por favor pregunte .{1,30}|entiendo\b.*|bonjour|merci(?: de \w+| pour \w+ \w+)?|desole|je comprends\b.*|hallo|guten tag|danke(?: fur \w+ \w+)?|tut mir leid|es tut mir leid|ich verstehe\b.*|bitte fragen sie .{1,30}|"
    r"नमस्ते|धन्यवाद|माफ़ कीजिए|क्षमा करें|மன்னிக்கவும்|வணக்கம்|நன்றி|வேறு ஏதாவது கேளுங்கள்|வேற ஏதாவது கேளுங்க|sorry|hi)(?: |$))+$"
)

# Names of the languages: a question that names one may be answered in it (without accents)
_ASKED = {
    "en": r"\b(?:english|ingles|anglais|englisch\w*)\b|ஆங்கில|अंग्रेज|इंग्लिश",
    "es": r"\b(?:spanish|espanol|castellano|espagnol|spanisch\w*)\b|ஸ்பானி|स्पेनिश",
    "fr": r"\b(?:french|frances|francais|franzosisch\w*)\b|பிரெஞ்சு|பிரஞ்சு|फ्रेंच|फ़्रेंच|फ्रांसीसी|फ़्रांसीसी",
    "de": r"\b(?:german|aleman|allemand|deutsch\w*)\b|ஜெர்மன்|ஜெர்மானிய|जर्मन",
    "hi": r"\bhindi\b|இந்தியில்|இந்தி மொழி|ஹிந்தி|हिंदी|हिन्दी",
    "ta": r"\b(?:tamil|tamoul|tamilisch\w*)\b|தமிழ|तमिल",
}
_ASKED_RE = {k: re.compile(v) for k, v in _ASKED.items()}
# beginnings of those names, one of which a text must hold
_ASKED_LATIN = ("engl", "ingl", "angl", "span", "espa", "cast", "fren", "fran", "germ", "alem", "deut", "hindi", "tam")
_ASKED_OTHER = ("ஆங்", "ஸ்பா", "பிர", "ஜெர்", "இந்தி", "ஹிந்", "தமிழ", "अंग्र", "इंग्ल", "स्पेन", "फ्र", "फ़्र", "जर्म", "हिं", "हिन्", "तमिल")
_PERSONS = frozenset(
    """i me my mine we us our ours you your yours am are yo mi mis me nos nuestro nuestra tu su sus usted je j mon ma mes nous notre nos vous votre vos m
    ich mein meine meinem meinen mich wir uns unser sie ihr ihre ihrem ihren எனது என் எனக்கு எங்கள் உங்கள் உங்களுக்கு मेरा मेरे मेरी मुझे हम हमारा हमारे आप आपका आपके आपकी आपको re fwd aw""".split()
)  # persons that a repeated question may exchange, and reply marks

_CLOSED = re.compile(r"[.!?।॥。？！][\"'”’»)\]*_`]*$|[\"”»)\]]$|```$")
_DANGLING = re.compile(r"(?:[,;:(\[{/&+=„“«‘¿¡<|\\]|(?<!\S)[-–—`*]+|[^\W\d_][-–—])$|(?:^|\n)[ \t>]*(?:\d{1,3}[.)]|[-*•])$")
_DOTS = re.compile(r"(?:…|\.\.+)$")
_TAIL_MARKS = " \t\r\n\x0b\x0c\xa0`"
_ITEM = re.compile(r"[ \t>]*\d{1,3}[.)][ \t]")
_FULL_STOPS = frozenset(".!?।॥。？！")
_LIST_END = re.compile(r"(?:^|\n)[ \t>]*\d{1,3}[.)]\W*$")
_OPENERS = re.compile(r"[(\[{\"“„«»]")
_DELIMITER = re.compile(r"(?<![:;=8])-?[(\[{]|[)\]}]|[“”„«»]|(?<!\d)\"")
_CLOSES = {")": "(", "]": "[", "}": "{", "”": "“„", "“": "„", "«": "»", "»": "«", '"': '"'}


def unclosed(text: str) -> bool:
    """Whether a bracket or quotation mark stays open to the end of a text, code and logs aside. Smileys and inch marks are none."""
    if not _OPENERS.search(text):
        return False
    stack: list[str] = []
    for m in _DELIMITER.finditer(langid.clean(text)):
        c = m[0][-1]
        match = _CLOSES.get(c)
        if match is None:
            stack.append(c)
            continue
        k = len(stack) - 1
        while k >= 0 and stack[k] not in match:
            k -= 1
        if k >= 0:
            del stack[k:]  # what was open inside ends with it
        elif c in "“«»\"":  # marks that also open
            stack.append(c)
    return bool(stack)


_ACCENT = re.compile("[\u0300-\u036f]+")


def _unaccented(text: str) -> str:
    """Lower case, without accents on Latin letters."""
    t = text.lower()
    if t.isascii():
        return t
    return unicodedata.normalize("NFC", _ACCENT.sub("", unicodedata.normalize("NFD", t)))


def _bare(text: str) -> str:
    """Lower-case words without accents on Latin letters, one space between."""
    return " ".join(words(_unaccented(text.replace("’", "'"))))


# every refusal above holds one of these
_MAY_REFUSE = (
    "not", "n't", "n’t", "nt ", "unable", "decline", "refuse", "rather", "pass on", "beyond", "outside", "unanswered", "no comment", "no answer", "no puedo", "no podemos", "no podr", "no me", "no nos", "no le ", "no te ", "no os ",
    "prefiero no", "no est", "no tengo", "declinar", "rechazar", "negarme", "no quiero", "pas ", "impossible", "décliner", "decliner", "nicht", "keine", "ablehnen", "नहीं", "असमर्थ", "मना", "अनुमति", "देने की", "முடியாது", "இயலாது", "முடியவில்லை", "அனுமதி",
    "விரும்ப", "முடியல", "மாட்டேன்", "permission",
)


def declines(text: str, sentences: list[str]) -> bool:
    """An answer that declines and helps with nothing: every sentence of it is a refusal or courtesy, and one is a refusal."""
    if not sentences:
        return False
    first = sentences[0].lower()
    if not any(x in first for x in _MAY_REFUSE) and not _COURTESY.match(_bare(first)):
        return False
    low = text.lower()
    if not any(x in low for x in _MAY_REFUSE):
        return False
    refused = False
    for s in sentences:
        b = _bare(s)
        if _REFUSAL.search(b):
            if _BUT_HELPS.search(b):
                return False
            refused = True
        elif b and not _COURTESY.match(b):
            return False
    return refused


# a turn from declining to helping inside one sentence
_BUT_HELPS = re.compile(r"\b(?:but|yet|however|although|though|pero|aunque|mais|aber|doch|jedoch|आप|लेकिन|ஆனால்|ஆனா)\b.*\b(?:steps?|below|you can|here is|here are|come close|can be|try|pasos|puede|podra|etapes|pouvez|schritte|konnen sie|lasst sich)\b")


OPEN, CUT, ASK = 0, 1, 2  # complete; cut off; the corpus decides


def ending(text: str) -> int:
    """How a text (trimmed, no filler) ends: one of OPEN, CUT, ASK."""
    if text.count("```") % 2:
        return CUT
    if text.endswith("```"):
        return OPEN
    t = text.rstrip(_TAIL_MARKS)
    if not t:
        return OPEN
    end = t[-12:]
    if (t != text and text.count("`") % 2) or unclosed(t):
        return CUT
    if _DOTS.search(end):
        return ASK
    if _CLOSED.search(end):
        return OPEN
    return CUT if _DANGLING.search(end) else ASK


_ID, _END, _START = 0x3FFFFFFF, 0x40000000, 0x80000000  # a word's number, and marks for the last word of a complete sentence and the first of any


def tail_keys(w: np.ndarray) -> np.ndarray:
    """At every word a number for it and the two before it, as far as they stand in the same sentence."""
    x = w.astype(np.uint64)
    first = (x & np.uint64(_START)) > 0
    x &= np.uint64(_ID)
    before = np.concatenate([np.zeros(1, np.uint64), x[:-1]])
    before[first] = 0
    second = np.concatenate([np.zeros(1, np.uint64), before[:-1]])
    second[first] = 0
    with np.errstate(over="ignore"):
        h = (second * np.uint64(0x9E3779B97F4A7C15) ^ before) * np.uint64(0xD6E8FEB86659FD93)
        h = ((h ^ (h >> np.uint64(31))) ^ x) * np.uint64(0x9E3779B97F4A7C15)
        return (h ^ (h >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)


_SMALL = "conversation_id string, turn long, msg_id long, role int, h long, blank boolean, refusal boolean, cut int, tail long, lang long, n int, b0 long, b1 long"
_FEATURES = f"{_SMALL}, words binary"


class _Numbers:
    """Numbers of words under _ID; 0 for persons, which are left out."""

    def __init__(self, most: int = 300_000):
        self.known: dict[str, int] = dict.fromkeys(_PERSONS, 0)
        self.most = most

    def of(self, tokens: list[str]) -> list[int]:
        known = self.known
        try:
            out = [known[w] for w in tokens]
        except KeyError:
            if len(known) > self.most:
                self.known = known = dict.fromkeys(_PERSONS, 0)
            for w in tokens:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w) & _ID or 1
            out = [known[w] for w in tokens]
        return [x for x in out if x] if 0 in out else out


def _complete(sentence: str) -> bool:
    """Whether a sentence has its terminator; three dots and the number of a list item are none."""
    z = sentence.rstrip()
    if z[-1:] not in _FULL_STOPS or z.endswith(".."):
        return False
    return not (z[-2:-1].isdigit() and _LIST_END.search(z[-12:]))


def _featuriser(model: langid.Model) -> Callable:
    short = [c.split("-")[0] for c in model.classes]
    bit = {c: 1 << k for k, c in enumerate(sorted({*short, *_ASKED}))}  # a language is a bit: there are under 63 of them

    def features(b: pa.RecordBatch, number: _Numbers, known: dict[str, tuple[str | None, int, list[int], bool]]) -> pa.RecordBatch:
        cid, turn, msg, role, content = (b.column(k) for k in range(5))
        roles = role.to_pylist()
        texts = content.to_pylist()
        blank = [langid.is_filler(t) for t in texts]
        # what other roles say is neither judged nor compared
        split = [[] if e or r > 1 else langid.split_sentences(t) for e, r, t in zip(blank, roles, texts, strict=True)]
        # a sentence that was met before is not read again: its language, tokens, numbers, and whether it has its terminator
        if len(known) > SENTENCES:
            known.clear()
        fresh = {s: langid.sentence_tokens(s) for ss in split for s in ss if s not in known}
        # sentences of more than one letter have a language
        flat = [t for t in fresh.values() if len(t) > 1 or (t and len(t[0]) > 1)]
        label = iter(model.predict(flat)[0].tolist()) if flat else iter(())
        for s, tok in fresh.items():
            lang = short[next(label)] if len(tok) > 1 or (tok and len(tok[0]) > 1) else None
            x = number.of(tok)
            if x:
                x[0] |= _START
            known[s] = lang, len(tok), x, _complete(s)
        hashes, refusals, cuts, langs, lens = [], [], [], [], []
        every: list[int] = []
        for t, r, e, ss in zip(texts, roles, blank, split, strict=True):
            weight: dict[str, int] = {}
            before = len(every)
            for k, s in enumerate(ss):
                lang, size, x, complete = known[s]
                if lang is not None:
                    weight[lang] = weight.get(lang, 0) + size
                if x:
                    every += x
                    # a sentence with its terminator, or a list item that another one follows
                    if complete or (k + 1 < len(ss) and _ITEM.match(s)):
                        every[-1] |= _END
            lens.append(len(every) - before)
            mask = 0
            if r == 0 and not e:  # what a question uses or asks for
                bare = _unaccented(t)
                if any(x in bare for x in _ASKED_LATIN) or (not bare.isascii() and any(x in bare for x in _ASKED_OTHER)):
                    mask = sum(bit[k] for k, p in _ASKED_RE.items() if p.search(bare))
                for k in weight:
                    mask |= bit[k]
            elif weight:  # the language of most of an answer
                mask = bit[min(weight, key=lambda k: (-weight[k], k))]
            hashes.append(xxhash.xxh64_intdigest(f"{r}\x1f{t}") - 2**63)
            refusals.append(r == 1 and not e and declines(t, ss))
            cut = OPEN if e or r != 1 else ending(t)
            cuts.append(OPEN if cut == ASK and not lens[-1] else cut)  # a text without words ends as it likes
            langs.append(mask)
        w = np.array(every, np.uint32)
        n = np.array(lens, np.int64)
        upto = np.cumsum(n)
        asks = np.array(cuts) == ASK
        tails = pa.array(tail_keys(w)[np.where(asks, upto - 1, 0)].view(np.int64) if len(w) else np.zeros(len(n), np.int64), mask=~asks)
        # 128 bits, one for each word: what an answer's bits have beside its question's, the question lacks
        bits = np.zeros((len(n), 128), np.uint8)
        bits[np.repeat(np.arange(len(n)), n), ((w & np.uint32(_ID)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(57)).astype(np.int64)] = 1
        packed = np.packbits(bits, axis=1).view(np.int64)
        words_ = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(np.concatenate([[0], upto * 4]).astype(np.int32)), pa.py_buffer(w)])
        return pa.RecordBatch.from_arrays(
            [cid, turn, msg, role.cast(pa.int32()), pa.array(hashes, pa.int64()), pa.array(blank, pa.bool_()), pa.array(refusals, pa.bool_()), pa.array(cuts, pa.int32()), tails, pa.array(langs, pa.int64()), pa.array(n.astype(np.int32)), *(pa.array(np.ascontiguousarray(packed[:, k])) for k in range(2)), words_],
            ["conversation_id", "turn", "msg_id", "role", "h", "blank", "refusal", "cut", "tail", "lang", "n", "b0", "b1", "words"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, known = _Numbers(), {}
        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                yield features(b.slice(at, ROWS), number, known)

    return run


def _tail_counter(asked: bytes) -> Callable:
    """Of (words) rows, for every key that may be asked for: places where a sentence ends with it, and all its places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.unpackbits(np.frombuffer(asked, np.uint8)).astype(bool)
        for b in batches:
            w = np.frombuffer(b"".join(b.column(0).to_pylist()), np.uint32)
            keys = tail_keys(w) if len(w) else np.zeros(0, np.uint64)
            near = wanted[(keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
            keys, of = np.unique(keys[near], return_inverse=True)
            ends = np.bincount(of, weights=(w[near] & np.uint32(_END)) > 0, minlength=len(keys)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ends), pa.array(np.bincount(of, minlength=len(keys)).astype(np.int64))], ["tail", "ends", "places"])

    return run


def complete_tails(features: DataFrame, ends: float = ENDS) -> DataFrame:
    """(tail, complete): the keys among those asked for (``tail``) at which sentences end often enough, over all ``words``."""
    slots = features.filter("tail IS NOT NULL").select(F.shiftrightunsigned("tail", 64 - SLOT_BITS).cast("int").alias("slot")).distinct().toArrow()
    asked = np.zeros(1 << SLOT_BITS, bool)  # bounded by its definition
    asked[slots.column("slot").to_numpy()] = True
    counts = features.filter("n > 0").select("words").mapInArrow(_tail_counter(np.packbits(asked).tobytes()), "tail long, ends long, places long")
    return counts.groupBy("tail").agg(F.sum("ends").alias("ends"), F.sum("places").alias("places")).filter(F.col("ends") >= F.greatest(F.lit(1.0), F.col("places") * ends)).select("tail", F.lit(True).alias("complete"))


def _copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conversation_id, run, question words, answer words) to the (conversation_id, run) whose answer is only the question again."""
    for b in batches:
        keep = []
        for k, (q, a) in enumerate(zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)):
            x, y = ([i & _ID for i in memoryview(z or b"").cast("I")] for z in (a, q))
            again = -(-len(x) // max(1, len(y)))  # an answer may say the question several times over
            if len(x) < 4:
                same = bool(y) and x == y * again
            else:
                known = set(y)
                same = sum(w in known for w in x) >= COPIED * len(x) and lcs_length(x, y * again) >= COPIED * len(x)
            if same:
                keep.append(k)
        take = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take)], ["conversation_id", "run"])


def number_runs(rows: DataFrame) -> DataFrame:
    """``rows`` (conversation_id, turn, msg_id, role, ..) with ``run`` and ``place``: successive rows of one role of a conversation, in turn order, have one run number; places rise in turn order.

    Numbers are dealt within stretches of BLOCK turn numbers and the stretches joined by what stands at their ends, so a
    conversation of any length is spread over tasks and a run may be of any length.
    """
    x = rows.withColumn("block", F.floor(F.col("turn").cast("double") / BLOCK))
    w = W.partitionBy("conversation_id", "block").orderBy("turn", "msg_id", "role")
    x = x.withColumn("k", F.row_number().over(w)).withColumn("run", F.sum(F.coalesce((F.lag("role").over(w) != F.col("role")).cast("bigint"), F.lit(0).cast("bigint"))).over(w))
    ends = x.groupBy("conversation_id", "block").agg(F.min_by("role", "k").alias("first"), F.max_by("role", "k").alias("last"), F.max("run").alias("changes"), F.count("*").alias("n"))
    wb = W.partitionBy("conversation_id").orderBy("block")
    starts = F.coalesce((F.lag("last").over(wb) != F.col("first")).cast("bigint"), F.lit(1).cast("bigint"))
    ends = ends.withColumn("starts", starts).select("conversation_id", "block", (F.sum(F.col("starts") + F.col("changes")).over(wb) - F.col("changes")).alias("base"), (F.sum("n").over(wb) - F.col("n")).alias("before"))
    return x.join(ends, ["conversation_id", "block"]).withColumn("run", F.col("run") + F.col("base")).withColumn("place", F.col("k") + F.col("before")).drop("block", "base", "before", "k")


def defects(messages: DataFrame, model: langid.Model, ends: float = ENDS) -> DataFrame:
    """(conversation_id, turn_index int, defects array<string>) for every pair with a defect, in the order of the rules.

    Rows without a whole number have no place in the turn order and take no part; a repeated message counts once; a null
    role is no role, a null content is empty. Different messages under one number stand in order of msg_id. An empty
    table gives no rows. Defects: empty, truncated, refusal, copy, other_language.
    """
    ship(messages.sparkSession)
    ev = turns.events(messages, F.col("msg_id").cast("bigint").alias("msg_id")).filter("turn IS NOT NULL")
    code = F.when(F.col("role") == "user", 0).when(F.col("role") == "assistant", 1).otherwise(2)
    f = materialize(ev.select("conversation_id", "turn", "msg_id", code.alias("role"), "content").mapInArrow(_featuriser(model), _FEATURES), "features")
    bits = ["b0", "b1"]
    # deliveries of a message have equal features
    once = f.groupBy("conversation_id", "turn", "role", "h").agg(F.min("msg_id").alias("msg_id"), *(F.first(c).alias(c) for c in ("blank", "refusal", "cut", "tail", "lang", "n", *bits)))
    rows = materialize(number_runs(once), "rows")
    full = ~F.col("blank")
    last = F.when(full, F.col("place"))
    runs = rows.filter("role < 2").groupBy("conversation_id", "run", "role").agg(
        F.min("turn").alias("turn"), F.bool_and("blank").alias("empty"), F.max_by("cut", last).alias("cut"), F.max_by("tail", last).alias("tail"), F.bool_and(F.when(full, F.col("refusal"))).alias("refusal"),
        F.bit_or(F.when(full, F.col("lang")).otherwise(F.lit(0).cast("bigint"))).alias("lang"), F.sum(F.when(full, F.col("n")).otherwise(0)).alias("n"),
        *(F.bit_or(F.when(full, F.col(b)).otherwise(F.lit(0).cast("bigint"))).alias(b) for b in bits),
    )
    asked = runs.filter("role = 0 AND NOT empty").select("conversation_id", (F.col("run") + 1).alias("run"), F.col("lang").alias("q_lang"), F.col("n").alias("q_n"), *(F.col(b).alias(f"q{b}") for b in bits))
    # a word of the answer that the question lacks has a bit of its own at best
    lacks = sum((F.bit_count(F.col(b).bitwiseAND(F.bitwise_not(f"q{b}"))) for b in bits), F.lit(0))
    may_copy = (F.col("n") > 0) & (F.col("q_n") > 0) & (lacks <= F.col("n") * (1 - COPIED))
    pairs = materialize(runs.filter("role = 1").join(asked, ["conversation_id", "run"]).select("conversation_id", "run", "turn", "empty", "cut", "tail", "refusal", "lang", "q_lang", may_copy.alias("may_copy")), "pairs")
    # tables of the few that may be copies, so that Spark knows their size and sends them to the words
    may = materialize(pairs.filter("may_copy").select("conversation_id", "run"), "may")
    both = may.select("conversation_id", "run", F.col("run").alias("pair")).unionByName(may.select("conversation_id", (F.col("run") - 1).alias("run"), F.col("run").alias("pair")))
    need = materialize(rows.filter(full).select("conversation_id", "run", "role", "place", "h").join(both, ["conversation_id", "run"]), "need")
    which = materialize(need.select("h").distinct(), "which")
    texts = f.select("h", "words").join(which, "h", "left_semi").groupBy("h").agg(F.first("words").alias("words"))
    said = need.join(texts, "h").groupBy("conversation_id", "pair", "role").agg(F.sort_array(F.collect_list(F.struct("place", F.hex("words").alias("x")))).alias("m"))
    said = said.select("conversation_id", F.col("pair").alias("run"), "role", F.unhex(F.array_join(F.transform("m", lambda v: v["x"]), "")).alias("w"))
    two = said.groupBy("conversation_id", "run").agg(F.max(F.when(F.col("role") == 0, F.col("w"))).alias("q"), F.max(F.when(F.col("role") == 1, F.col("w"))).alias("a"))
    copies = two.mapInArrow(_copies, "conversation_id string, run long").withColumn("copy", F.lit(True))
    # a pair that asks for nothing has a key of its own, so that no key is hot; keys that are asked for are known by it
    asks = F.coalesce((F.col("cut") == ASK) & ~F.col("empty"), F.lit(False))
    decided = pairs.withColumn("tail", F.when(asks, F.col("tail")).otherwise(F.xxhash64("conversation_id", "run"))).join(complete_tails(f, ends), "tail", "left").join(copies, ["conversation_id", "run"], "left")
    ends_short = (F.col("cut") == CUT) | (asks & F.col("complete").isNull())
    foreign = (F.col("lang") != 0) & (F.col("q_lang") != 0) & (F.col("lang").bitwiseAND(F.col("q_lang")) == 0)
    some = ~F.col("empty")
    rule = lambda ok, name: F.when(F.coalesce(ok, F.lit(False)), F.array(F.lit(name))).otherwise(F.array().cast("array<string>"))
    found: Column = F.concat(
        rule(F.col("empty"), "empty"), rule(some & ends_short, "truncated"), rule(some & F.col("refusal"), "refusal"), rule(some & F.col("copy"), "copy"), rule(some & foreign, "other_language")
    )
    return decided.select("conversation_id", F.col("turn").cast("int").alias("turn_index"), found.alias("defects")).filter(F.size("defects") > 0)
