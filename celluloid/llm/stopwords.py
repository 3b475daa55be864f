"""Frequent function words of a few languages."""

# Common function words, as any grammar lists them.
STOP_WORDS = {
    "de": "aber als am an auch auf aus bei das dass dem den der des die ein eine einem einen einer es für hat ich ihr im in ist mit nach nicht noch nur oder sich sie sind so über um und von vor war was wie wir wird zu zum zur",
    "en": "a about all an and are as at be been but by can for from had has have he her his i if in is it its my no not of on one or our she so that the their them there they this to was we were what when which who will with would you your",
    "es": "al como con de del donde el ella en entre era es esta este fue ha hay la las lo los más me mi muy no nos o para pero por que se ser si sin sobre son su sus también te tiene un una y ya yo",
    "fr": "au aux avec ce ces cette dans de des du elle en est et être eu il ils je la le les leur lui mais me même mon ne nous on ou où par pas plus pour qu que qui sa se ses son sont sur te tu un une vous",
    "it": "al alla anche che chi come con da dal dei del della di e è gli ha i il in io la le lo ma mi nel non o per più questo se si sono su un una",
    "nl": "aan als bij dat de den der die dit een en er het hij hoe ik in is je maar met niet nog of om ook op te tot uit van voor was wat we wel werd wordt zij zijn zo",
    "pt": "a ao as com como da das de do dos e ela em entre era essa este eu foi há isso mais mas me na não no nos o os ou para pela pelo por que se sem ser seu sua também um uma",
}
BY_WORD: dict[str, set[str]] = {}
for _language, _words in STOP_WORDS.items():
    for _word in _words.split():
        BY_WORD.setdefault(_word, set()).add(_language)
