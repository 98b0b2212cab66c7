"""Labelled sample phrases for the residue models: unfilled slots and filler, error texts and notices.

Fixed values. A phrase may hold alternatives ``{a|b}``; ``samples`` draws a bounded, seeded number of
expansions, which is the documented bound of the labelled sample that the models are fitted on.
"""

from __future__ import annotations

import random
import re

THING = "{page|report|issue|ticket|thread|document|discussion|article|resource|entry|site|content|question}"
SLOT = (
    "{title|steps|expected|actual|version|os|component|reporter|summary|description|name|function name|module name|"
    "test name|class name|issue title|bug summary|error message|repro code|expected result|actual result|affected file|"
    "your name|date|url|email|environment}"
)
SCRIPTS = "{JavaScript|Javascript|JS|Java Script|scripts|scripting|client-side scripts}"
STATUS = (
    "{400 Bad Request|401 Unauthorized|403 Forbidden|404 Not Found|408 Request Timeout|410 Gone|429 Too Many Requests|"
    "500 Internal Server Error|502 Bad Gateway|503 Service Unavailable|504 Gateway Timeout|520 Unknown Error}"
)
REASON = (
    "{bad request|unauthorized|forbidden|not found|request timeout|gone|too many requests|internal server error|"
    "bad gateway|service unavailable|gateway timeout|unknown error}"
)
SHAPED = "{title|steps|expected|os|reporter|version|function_name|issue_title|test_name|repro_code|FunctionName|Title|TITLE|STEPS|BUG_SUMMARY|OS}"

#: Slots by their punctuation, for the model over shapes.
SHAPES = (
    "{{@}}", "{{ @ }}", "{{{@}}}", "#{@}", "${@}", "<%= @ %>", "<% @ %>", "{% @ %}", "%(@)s", "%@%", "__@__", "@@@@@", "[[@]]",
    "<<@>>", "«@»", "$[@]", "{@}", "________", "________ (@)",
)
#: Slots of several words in capitals or in quotation brackets, for the same model.
CAPITALS = ("[BUG SUMMARY]", "<YOUR VERSION>", "[ISSUE TITLE]", "<YOUR NAME HERE>", "«issue title»", "«repro code»", "<<issue title>>")
#: Slots known by their words, for a model over letters with a short window.
WORDED = (
    f"[insert {SLOT}]", f"[your {SLOT}]", f"[todo add {SLOT}]", f"[todo: {SLOT}]", f"[add {SLOT} here]", f"<describe the {SLOT}>",
    f"<{SLOT} here>", f"<your {SLOT}>", f"<insert {SLOT}>", f"(fill in {SLOT})", f"(your {SLOT} here)", f"tbd: {SLOT}", f"todo: add {SLOT}",
)
CONTEXTS = (
    "@", "# @", "- expected: @", "- file: @", "Subject: @", "Version: @", "Found in @", "Reported by @", "Cheers, @",
    "While using @ the", "I am using @ on", "After updating @ the", "If I run @ the", "Problem in @", "Bug report for @", "\n@\n",
)

#: Slots in words, placeholders and filler.
FILLER = (
    f"[insert {SLOT}]", f"[INSERT {SLOT}]", f"[your {SLOT}]", f"[TODO add {SLOT}]", f"[TODO: {SLOT}]", f"[add {SLOT} here]",
    f"<describe the {SLOT}>", f"<{SLOT} here>", f"<your {SLOT}>", f"<insert {SLOT}>", f"(fill in {SLOT})", f"(your {SLOT} here)",
    f"TBD: {SLOT}", f"TODO: {SLOT}", f"[{SLOT} name]", f"<YOUR {SLOT}>", f"[{SLOT}]",
    f"{{Enter|Put|Type|Write|Add|Insert|Describe}} your {THING} {{here|below|in this space|in this field}}.",
    f"{{Enter|Put|Type|Write|Add|Insert}} your {{summary|description|text|comment|answer|title|problem statement}} {{here|below|in this space|in this box}}.",
    "{Replace|Change|Overwrite|Swap out|Exchange} this {line|section|paragraph|text|sentence|part} with "
    "{what you saw|the real description|your own words|a description|the actual text|your report}.",
    "Delete this {line|paragraph|section|text} {afterwards|before submitting|when done}.",
    "Remove this {line|text|section} {afterwards|before posting}.",
    "{Placeholder|Dummy|Sample} {issue body|description|text|content|body} {to be replaced later|until the real one is written|to follow}.",
    "{Body|Description|Text|Details|Summary|Content} {to be added|not written yet|to follow|to be written|will follow|coming soon}.",
    "{Default|Demo|Dummy|Sample|Example|Test} {text|content|body|issue body|description} {only|for layout purposes|for testing|goes here}.",
    "{Body|Description|Text|Content|Details} {pending|missing|to come|follows}.", "{Body|Details|Description} pending.",
    "{Blah blah|Yada yada|Bla bla bla|Etc etc}, {will write up|will describe|will fill in|to be described} {properly|in full|in detail|} {tomorrow|later|soon|next week}.",
    "{Will|I will|We will|To be} {fill this in|write this up|add details|complete this|describe this} {later|tomorrow|soon|at some point}.",
    "{Nothing|No text|No description|No details|No summary} {here yet|written yet|provided|given|available yet}.",
    "{This is|Just} {a test|only a test|some test text|placeholder text|sample text}, {please ignore|ignore it|to be replaced}.",
    "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua.",
    "Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat.",
    "Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur.",
    "Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum.",
)
FORM_HEADS = "Steps Expected Actual Notes Summary Environment Logs Description Version Result".split()
#: Lines that name a part of a report, filled or not.
HEADS = tuple(sorted({h.lower() for h in [*FORM_HEADS, *SLOT.strip("{}").split("|")]}))
FORM_ENDS = (":", " -", "")
FORM_VALUES = ("tbd", "TBD", "n/a", "N/A", "x", "xxx", "...", "-", "to be written", "same text as above", "none yet", "todo", "?")
WORD_ROWS = (
    "{Word|Line|Sentence|Item|Point|Text|Paragraph} {one|two|three|four|five|A|B|C}.",
    "{Some|More|Other} {words|text}.", "Another line of {words|text}.", "Here is a sentence.", "Here is some text.", "This is a line.",
)
PSEUDO_LATIN = (
    "lorem ipsum dolor sit amet magna vitae sed mundi adipi nova fela cilla porta restor ector aliqua egesta venis nibh dictum "
    "pretis viver labor quavis tempor orna tirra soluti ut vamen terun palid luctus fermen conse moribun nunc consectetur "
    "elit eiusmod incididunt dolore enim minim veniam nostrud ullamco laboris nisi commodo consequat pharetra mattis"
).split()
MASHED = "asdf qwer foo bar baz zzz xxx aaa aaaa 123 111 test text sdfg blah abc qwerty zxcv hjkl".split()

#: Texts of failed or refused requests, sign-in walls, error pages, and notices about scripts and browser checks.
NOTICES = (
    "{Rate limit reached.|Quota used up.|Rate limit exceeded.|Too many requests.} {|(9)|Try again later.}",
    "Rate limit reached. {|(9)|Slow down.}", f"Status {STATUS}", f"{STATUS}", f"HTTP {STATUS}", f"Error {STATUS}", f"{STATUS}\n\nThe {THING} is not available.", "{400|403|404|410|500|502|503|504|520}: {Bad Request|Not Found|Gone|Unauthorized|Forbidden|Service Unavailable}",
    "HTTP {400|404|500|503}{:| -} {Bad Request|Not Found|Internal Server Error|Service Unavailable|Too Many Requests|Request Timeout}",
    "{403|404|500|502|504|520} - {Not Found|Forbidden|Gateway Timeout|Unknown Error|Bad Gateway|Unauthorized}", "Error code: {404|500|503}", "Code: {404|500|503}",
    f"<html>\n<head><title>{STATUS}</title></head>\n<body>\n<h1>{{Error|404|503|Not Found|Forbidden|Bad Gateway|Service Unavailable|Too Many Requests|Unknown Error}}</h1>\n"
    "<p>{Try again later.|Please try again in 9 minutes.|Reload in a moment.|Next retry in 42 s.|12345}</p>\n</body>\n</html>",
    f'{{{{"error": {{{{"code": {{400|404|410|500|520}}, "message": "{REASON}", "request": "ab-12"}}}}}}}}',
    f'{{{{"status":{{404|500|503}},"detail":"{{Bad Gateway|Not Found|Service Unavailable|Forbidden}}","trace":"9f"}}}}',
    f'{{{{"ok": false, "reason": "{REASON}"}}}}',
    "{Something went wrong|An unexpected problem occurred|That did not work|An error occurred} on our {end|side|servers}. "
    "{We are looking into it.|Our team has been told.|Please try again later.} {Error reference: |Event: |id=|Incident |Reference |(ref 9)}",
    "{Oops!|Uh oh.|Sorry.|Hmm.} {We could not find|We cannot show|Nobody found|There is no longer} the "
    f"{THING} you {{were looking for|requested|asked for}}. {{Return home.|Check the address.|Go back to the start page.}}",
    f"The {THING} is not available.", f"The {THING} {{was not found|does not exist|has moved|has been removed}}.",
    "{Access denied.|Not allowed.|Permission required.|Sign-in required.|Forbidden.} "
    f"{{You do not have permission to view|You need an account to view|You are not allowed to view|You must sign in to see}} this {THING}. "
    "{Sign in to continue.|Ask an administrator.|Log in to continue.}",
    "{You have been signed out.|Your session has expired.|Your login has expired.|This link is no longer valid.} "
    f"{{Please log in again to open|Start over to open|Request a new link to open|Sign in again to open}} the {THING}.",
    "{Rate limit reached.|Quota used up.|Too many requests from your network.|Request limit exceeded.} "
    "{Try again later.|Please try again in 9 minutes.|Reload in a moment.|Next retry in 42 s.}",
    "The {service|backend|mirror|server|tracker|site} is {temporarily unavailable|overloaded right now|not responding|down for maintenance}. "
    "{Try again later.|Please try again in 9 minutes.|Reload in a moment.|Next retry in 42 s.|}",
    "{Empty response.|No content was generated.|Nothing was written.|The failure was recorded.}",
    "{ERROR|Failure|Error}: {generation|completion|model|chat} request {gave up|was rejected|failed|timed out} after 9 attempts "
    "({Request Timeout|Too Many Requests|Service Unavailable|Bad Gateway|Internal Server Error}). {No content was generated.|Nothing was written.|Empty response.|The failure was recorded.}",
    f"{{Please|Kindly}} {{enable|turn on|activate|switch on|allow}} {SCRIPTS}{{| and cookies}} {{in your browser |}}to {{continue to|load|open|view|read}} {{this|the}} {THING}.",
    f"You {{must|need to|have to}} {{enable|turn on|activate|switch on|allow}} {SCRIPTS} {{in your browser |}}to {{continue to|load|open|view}} {{this|the}} {THING}.",
    f"To continue, {{enable|turn on|activate|switch on|allow}} {SCRIPTS} in your browser to {{continue to|load|open|view}} {{this|the}} {THING}.",
    f"Your browser {{does not support|has blocked|has switched off|does not run}} {SCRIPTS}, so this {THING} cannot be {{shown|displayed|rendered}}.",
    f"This site works {{only|best|properly only}} with {SCRIPTS} {{active|enabled|allowed}}; {{it appears to be disabled|we could not detect it|it seems to be off}}.",
    f"<noscript>{{The tracker|This application|This {THING}}} {{requires|needs|depends on}} {SCRIPTS}. "
    "{Turn it on and reload.|Check your settings.|Nothing to show without it.}</noscript>",
    f"{{Checking your browser|One moment, testing your connection|Verifying that you are human}} before loading the {THING}. "
    f"This {{requires|needs}} {SCRIPTS} and cookies.",
    "{Whoops|Oops|Oh no|Uh oh|Yikes}{,|!} {looks like|it seems that|it looks like|it appears that} {something|this page|our server|the site} {broke|went wrong|failed|crashed}.",
    f"We {{noticed|detected|see}} {{that |}}{SCRIPTS} {{is off|is disabled|is turned off|is not available|is blocked}}{{| in your browser}}. "
    "{Switch to a supported browser|Please enable it|Turn it on|Change your settings} {to continue|to keep using this site|and reload the page}.",
    "As {an AI language model|an AI|a language model|an AI assistant|an assistant}, I {cannot|can't|am unable to|am not able to} "
    "{complete|fulfil|help with|answer|process} {this request|that request|this task|your question}.",
    "{I'm sorry|Sorry|I apologize}, but I {can't|cannot|am unable to} {help|assist} with {that|this|that request}.",
    "{Please|You must|You need to} {complete|solve|pass} the {captcha|security check|challenge} to {continue|access this site|prove you are human}.",
    "{Verify|Confirm|Prove} {that you are|you are} {human|not a robot} {by completing the action below|to continue|before proceeding}.",
    f"{{Subscribe|Create an account|Register|Sign up|Log in}} to {{read|view|see}} the {{full|rest of the|whole|complete}} {THING}.",
    "The server {encountered|met} an {internal error|unexpected condition} {and was unable to|and could not|that stopped it from being able to} {complete|fulfil|handle} your request.",
    "{Your browser|This version of your browser} is {not supported|no longer supported|out of date}. {Please upgrade|Update it|Use a newer one} to {continue|view this page|use this site}.",
    f"{{This|The}} {{site|page|{THING}}} {{can't be reached|isn't working right now|took too long to respond}}.",
    "{Learn more.|Then refresh.|Reload once it is active.}", "Loading...", "Skip to content", "Help | Terms | Status",
    "{Bitte aktivieren Sie|Schalten Sie|Erlauben Sie|Sie müssen} {JavaScript|Skripte} {im Browser ein|einschalten|}, um "
    "{diese Seite anzuzeigen|den Eintrag zu lesen|fortzufahren}.",
    "{Veuillez activer|Merci d’autoriser} {JavaScript|les scripts} pour {afficher cette page|lire ce ticket|continuer}.",
    "{Habilite|Active|Debe permitir} {JavaScript|el uso de scripts} en su navegador para {ver el contenido|abrir el informe|continuar}.",
    "{Seite nicht gefunden|Interner Fehler|Zugriff verweigert|Dienst nicht erreichbar} ({404|500|403|504}). "
    "{Die angeforderte Adresse existiert nicht.|Bitte versuchen Sie es später erneut.|Vorgang 123.}",
    "{Página no encontrada|Error interno del servidor|Acceso denegado|Servicio no disponible} - {404|500|403}\n{Vuelva a intentarlo más tarde|La dirección no existe}",
    "{Page introuvable|Erreur interne du serveur|Accès refusé|Service indisponible} ({404|500|403}). {Veuillez réessayer plus tard.|Cette adresse n’existe pas.}",
)


def expand(phrase: str, rng: random.Random) -> str:
    """One expansion; ``{{`` and ``}}`` are literal braces."""
    phrase = phrase.replace("{{", "\x01").replace("}}", "\x02")
    while True:
        filled = re.sub(r"\{([^{}]*)\}", lambda m: rng.choice(m[1].split("|")), phrase)
        if filled == phrase:
            return filled.replace("\x01", "{").replace("\x02", "}")
        phrase = filled


def samples(name: str, each: int) -> list[str]:
    """Labelled texts of a class: slot (before they are made shapes), worded, filler or notice.

    each: expansions of every phrase; it bounds the labelled sample.
    """
    rng = random.Random(5)
    if name == "slot":
        return [
            c.replace("@", s.replace("@@@@@", "@@\x00@@").replace("@", "\x00", 1) if s != "@@@@@" else "\x01\x01\x00\x01\x01")
            .replace("\x00", expand(SHAPED, rng)).replace("\x01", "@")
            for s in SHAPES for c in CONTEXTS for _ in range(max(1, each // 8))
        ] + [c.replace("@", s) for s in CAPITALS for c in CONTEXTS]
    if name == "worded":
        return [f" {expand(p, rng)} " for p in WORDED for _ in range(each)]
    if name == "notice":
        return [expand(p, rng) for p in NOTICES for _ in range(each)]
    out = [expand(p, rng) for p in FILLER for _ in range(each)]
    for _ in range(each * 4):
        words = [rng.choice(PSEUDO_LATIN) for _ in range(20)]
        out.append(f"{' '.join(words).capitalize()}.")
        for _ in range(2):
            picked = rng.sample(MASHED, 2)
            out.append(rng.choice([" ", ", "]).join(rng.choice(picked) for _ in range(12)))
        out.append(" ".join(expand(rng.choice(WORD_ROWS), rng) for _ in range(6)))
        value, end, gap = rng.choice(FORM_VALUES), rng.choice(FORM_ENDS), rng.choice(["\n", "\n\n", " "])
        out.append("\n".join(f"{h}{end}{gap}{value}" for h in rng.sample(FORM_HEADS, 4)))
        out.append(value)
    return out
