"""Values that results depend on, as data. Each is a default of some operator's parameter."""

# Ordered spelling pairs (old, new), applied one after the other.
SPELLING_PAIRS = (
    ("อัลลอฮ์", "อัลลอฮฺ"),
    ("รอซูลุลลอฮ์", "รอซูลุลลอฮฺ"),
    ("ร่อซูลุลลอฮ์", "รอซูลุลลอฮฺ"),
    ("ร่อซูลุลลอฮฺ", "รอซูลุลลอฮฺ"),
    ("บิสมิลลาฮ์", "บิสมิลลาฮฺ"),
    ("ซุบฮานัลลอฮ์", "ซุบฮานัลลอฮฺ"),
    ("อินชาอัลลอฮ์", "อินชาอัลลอฮฺ"),
    ("อัลฮัมดุลิลลาฮ์", "อัลฮัมดุลิลลาฮฺ"),
    ("กิยามะฮ์", "กิยามะฮฺ"),
    ("กิยามะห์", "กิยามะฮฺ"),
    ("กียามะฮ์", "กิยามะฮฺ"),
    ("อาคิเราะฮ์", "อาคิเราะฮฺ"),
    ("อาคิเราะห์", "อาคิเราะฮฺ"),
    ("อาคีเราะห์", "อาคีเราะฮฺ"),
    ("อิบาดะฮ์", "อิบาดะฮฺ"),
    ("อิบาดะห์", "อิบาดะฮฺ"),
    ("มลาอิกะฮ์", "มลาอิกะฮฺ"),
    ("มลาอิกะห์", "มลาอิกะฮฺ"),
    ("มะลาอิกะฮ์", "มลาอิกะฮฺ"),
    ("มะลาอิกะห์", "มลาอิกะฮฺ"),
    ("มะลาอีกะฮ์", "มลาอิกะฮฺ"),
    ("มลาอีกะฮ์", "มลาอิกะฮฺ"),
    ("ฮิดายะฮ์", "ฮิดายะฮฺ"),
    ("ชะฟาอะฮ์", "ชะฟาอะฮฺ"),
    ("เตาบะฮ์", "เตาบะฮฺ"),
    ("ฟิตนะฮ์", "ฟิตนะฮฺ"),
    ("ฟิตนะห์", "ฟิตนะฮฺ"),
    ("ซุนนะฮ์", "ซุนนะฮฺ"),
    ("ซุนนะห์", "ซุนนะฮฺ"),
    ("อะมานะฮ์", "อะมานะฮฺ"),
    ("มุอฺมินะฮ์", "มุอฺมินะฮฺ"),
    ("เศาะฮาบะฮ์", "เศาะฮาบะฮฺ"),
    ("หิกมะฮ์", "หิกมะฮฺ"),
    ("ฮิกมะฮ์", "หิกมะฮฺ"),
    ("อุมเราะฮ์", "อุมเราะฮฺ"),
    ("ดียะฮ์", "ดียะฮฺ"),
    ("กิบละฮ์", "กิบละฮฺ"),
    ("มัรวะฮ์", "มัรวะฮฺ"),
    ("บัยอะฮ์", "บัยอะฮฺ"),
    ("กะลาละฮ์", "กะลาละฮฺ"),
    ("ญานาซะฮ์", "ญะนาซะฮฺ"),
    ("ญาฮิลียะฮ์", "ญาฮิลียะฮฺ"),
    ("อัลญาฮิลียะฮ์", "อัลญาฮิลียะฮฺ"),
    ("กะอ์บะฮ์", "กะอฺบะฮฺ"),
    ("กะอ์บะฮฺ", "กะอฺบะฮฺ"),
    ("ชะฮาดะฮ์", "ชะฮาดะฮฺ"),
    ("ซะกาฮ์", "ซะกาฮฺ"),
    ("เราะห์มาน", "เราะฮฺมาน"),
    ("รอห์มาน", "รอฮฺมาน"),
    ("เราะห์มัต", "เราะฮฺมัต"),
    ("เราะห์มัด", "เราะฮฺมัด"),
    ("อะฮ์ลุลกิตาบ", "อะฮฺลุลกิตาบ"),
    ("อัลเลาฮุลมะฮฟูซ", "อัลเลาฮุลมะฮฺฟูซ"),
    ("มะฮฟูซ", "มะฮฺฟูซ"),
    ("มะห์ฟูซ", "มะฮฺฟูซ"),
    ("มะห์ชัร", "มะฮฺชัร"),
    ("ตัสบีห์", "ตัสบีหฺ"),
    ("นิกาห์", "นิกาหฺ"),
    ("ศุบห์", "ศุบหฺ"),
    ("มิห์รอบ", "มิหฺรอบ"),
    ("อัรรูห์", "อัรรูฮฺ"),
    ("เอี๊ยะห์รอม", "อิหฺรอม"),
    ("อิห์รอม", "อิหฺรอม"),
    ("รอกะอะฮ์", "ร็อกอะฮฺ"),
    ("ซูเราะฮ์", "ซูเราะฮฺ"),
    ("ซูเราะห์", "ซูเราะฮฺ"),
    ("อายะฮ์", "อายะฮฺ"),
    ("อายะห์", "อายะฮฺ"),
    ("มักกะฮ์", "มักกะฮฺ"),
    ("มักกะห์", "มักกะฮฺ"),
    ("มะดีนะฮ์", "มะดีนะฮฺ"),
    ("มะดีนะห์", "มะดีนะฮฺ"),
    ("มาดีนะฮ์", "มะดีนะฮฺ"),
    ("อันฏอกียะฮ์", "อันฏอกียะฮฺ"),
    ("อัลบะเกาะเราะฮ์", "อัลบะเกาะเราะฮฺ"),
    ("อัลบะกอเราะฮ์", "อัลบะเกาะเราะฮฺ"),
    ("อัลฟาติฮะฮ์", "อัลฟาติฮะฮฺ"),
    ("อัลเกาะรีอะฮ์", "อัลเกาะรีอะฮฺ"),
    ("อัล-กะฮ์ฟ", "อัล-กะฮฺฟ"),
    ("อัส-สัจญ์ดะฮ์", "อัส-สัจญ์ดะฮฺ"),
    ("นูห์", "นูฮฺ"),
    ("นุห์", "นุฮฺ"),
    ("นูฮ์", "นูฮฺ"),
    ("ยะห์ยา", "ยะฮฺยา"),
    ("ยะฮห์ยา", "ยะฮฺยา"),
    ("โอ้ยะห์ยา", "โอ้ยะฮฺยา"),
    ("อัลมะซีห์", "อัลมะซีหฺ"),
    ("มะซีห์", "มะซีหฺ"),
    ("ศอลิห์", "ศอลิหฺ"),
    ("ศอและห์", "ศอและฮฺ"),
    ("ซอและห์", "ซอและฮฺ"),
    ("ลู๊ฏ", "ลูฏ"),
    ("นบีลูต", "นบีลูฏ"),
    ("มูฮัมหมัด", "มุฮัมมัด"),
    ("มูฮัมมัด", "มุฮัมมัด"),
    ("อิบราฮิม", "อิบรอฮีม"),
    ("อิสมาอิล", "อิสมาอีล"),
    ("ชุอัยบ์", "ชุอัยบฺ"),
    ("ฟิรอาวน์", "ฟิรเอานฺ"),
    ("ฟิรเอาน์", "ฟิรเอานฺ"),
    ("ยะอ์กูบ", "ยะอฺกูบ"),
    ("สะบะอ์", "สะบะอฺ"),
    ("ดุลกอฮ์นัยน์", "ซุลก็อรนัยน์"),
)

# Endings rewritten after the pairs.
SPELLING_ENDINGS = (("ะฮ์", "ะฮฺ"), ("ะห์", "ะฮฺ"))

# Particles that cannot stand for a verb, and those that cannot stand for a noun.
VERB_PARTICLES = ("ว่า", "จะ", "ที่", "ของ", "ใน", "ณ", "คน", "เอง", "หรือ", "และ", "เพื่อ", "จาก", "แด่", "แก่", "ซึ่ง", "จึง")
NOUN_PARTICLES = ("ว่า", "จะ", "ที่", "ของ", "ใน", "และ", "เพื่อ", "หรือ", "จึง")

# Negation markers, dictionary leaks, scripts foreign to the text, digits-only source words.
NEGATIONS = ("ไม่", "มิ", "หาไม่", "อย่า", "หามิได้", "เว้นแต่", "นอกจาก", "ใดๆ")
DICTIONARY_LEAKS = ("พจนานุกรม", "ฯพณฯ")
FOREIGN_SCRIPTS = "[\uAC00-\uD7AF\u0590-\u05FF\u4E00-\u9FFF]"
DIGITS_ONLY = "^[0-9\u0660-\u0669]+$"

# Messages of the word rules, with the text in place of {}.
WORD_MESSAGES = (
    "Foreign character detected in Thai translation: '{}'",
    "Slash gloss detected: '{}'",
    "Verb reduced to bare particle '{}'",
    "Noun reduced to bare particle '{}'",
    "Negative missing negation element: '{}'",
    "Unmatched parentheses in: '{}'",
    "Suspicious single-character word: '{}'",
    "Lexical dictionary leak: '{}'",
)

# Statuses of guarded edits, spacing edits and marker placement.
PASSED = "PASSED_GUARDRAIL"
PURE_SPACING = "REJECTED_PURE_SPACING (Handled exclusively by Pipeline 2)"
NOT_VERBATIM = "Target phrase '{}' was not found verbatim in master Thai verse."
NOTE_REMOVED = "Unauthorized deletion of parenthetical tafsir note: {}"
TYPO_TOO_LONG = "Typo fix altered length by {} characters (expected <= 15 chars)."
SHRUNK = "Mistranslation fix shrank text by {} characters (potential clause drop)."
CHARACTER_MISMATCH = "REJECTED_CHARACTER_MISMATCH"
POST_PROCESS_MISMATCH = "REJECTED_POST_PROCESS_MISMATCH"
SPACING_CHANGED, SPACING_CLEAN = "SPACING_OPTIMIZED", "CLEAN"
PLACED_WELL, PLACED_LIKELY, PLACED_REVIEW, PLACED_ADRIFT = "PERFECT", "HIGH_CONFIDENCE", "REVIEW_SUGGESTED", "MISALIGNED_DRIFT"

# The issue type of a logged change without one, and what its explanation begins with.
REVIEW_ISSUE, REVIEW_NOTE = "THEOLOGICAL_REVIEW", "[Scholar Review Approved] "

# Reviewer answers.
APPROVALS = ("APPROVED", "APPROVE", "ACCEPT", "YES", "TRUE", "1")
REFUSALS = ("REJECTED", "REJECT", "NO", "FALSE", "0")

# Combining marks that a cut must not part from their base, and two marks that comparison ignores.
COMBINING_MARKS = "\u0E31\u0E34\u0E35\u0E36\u0E37\u0E38\u0E39\u0E3A\u0E47\u0E48\u0E49\u0E4A\u0E4B\u0E4C\u0E4D\u0E4E"
IGNORED_MARKS = "\u0E4C\u0E3A"

# What marks the containers of keyed pages, and the fallback.
BOX_KEY_PREFIX, BOX_CLASS = "quran-", "border-gold-400"
KEY_CLASSES = ("tracking-tight", "font-extrabold")
#: Fixed: the labels before an item's text and its notes.
TEXT_LABEL, NOTE_LABEL = "Translation", "Comment"

# Characters that become spaces, then regular spacing around repetition marks and brackets, as
# (pattern, replacement), in this order. {ws} is white space, {word} anything else, {thai} a letter, {gap} white space that is no letter.
NO_WIDTH = "\u00a0\u200b\u200c\u200d\ufeff"
SPACING_RULES = (
    ("({word}){ws}*ๆ{ws}*({thai})", "$1 ๆ $2"),
    ("({word}){ws}*ๆ(?={gap}|\\z)", "$1 ๆ"),
    ("({thai})\\(", "$1 ("),
    ("\\)({thai})", ") $1"),
    ("\\({ws}+", "("),
    ("{ws}+\\)", ")"),
)
THAI, REPETITION = "[ก-๙]", "ๆ"
