"""Frequent function words of four languages, in natural order."""

ENGLISH = (
    "a an and are as at be by for from in is it of on or that the this to was with".split()
)
FRENCH = "au dans de des du en est et la le les par pas pour que sur un une".split()
GERMAN = "auf das dem den der des die ein eine für im ist mit nicht sich und von zu".split()
SPANISH = "al con de del el en es la las los no para por que se su un una y".split()

COMMON_WORDS = tuple(dict.fromkeys([*ENGLISH, *FRENCH, *GERMAN, *SPANISH]))
