"""Schemas of the files read and written; nothing is inferred. Field names are those of the file formats."""

UTTERANCE = "timeline string, ligne int, locuteur string, role string, texte string, id string, chemin string"
FORGE_LINES = "id string, chapitre string, texte string, role string, source string, exaggeration double, cfg_weight double, registre string, instruct string"
FINGERPRINT_VECTORS = "vecteurs array<struct<cas:string,texte:string,normalise:string,empreinte:string>>"
FILE_ENTRY = "struct<id:string,fichier:string,sha256:string,moteur:string,chapitre:string,texte:string>"
VOICE_ENTRY = f"struct<nom:string,repliques:int,format:string,convention:string,moteur_par_defaut:string,fichiers:array<{FILE_ENTRY}>>"
MANIFEST = f"projet string, source string, version_pack string, construit string, contenu array<string>, medias struct<video:array<string>,animation:array<string>>, voix map<string,{VOICE_ENTRY}>"
VOICE_MANIFEST = "personnage string, mode string, speaker string, description string, format string, repliques array<struct<id:string,texte:string,fichier:string,instruct:string>>"
CANDIDATES = "slug string, candidats array<struct<n:int,description:string,seed:int,wav:string>>"
CHOICE = "n int, description string, seed int, wav string, valide string, auto boolean"
STAGE_PLAN = "characters array<struct<id:string,stages:array<struct<id:string,label:string,chapters:array<int>>>>>"
AUDIT_CLIP = "fichier string, personnage string, id string, texte string, duree double, fin double"
