"""Pattern and keyword packs: small ones built in, large ones read from files.

A pack file has one entry a line, in order; empty lines and lines that start with "# " are
left out. patterns_<country>.txt holds regular expressions, blacklist.txt plain keywords. Both
may be Python files instead that state such a list, which are read but not run.
"""

from __future__ import annotations

import ast
from pathlib import Path

#: Chains of Mexico, as regular expressions. Fixed values.
MX_CHAINS = (
    r"\bwalmart\b",
    r"\bbodega\s?aurrera\b",
    r"\bmi\s?bodega\b",
    r"\baurrera\s?express\b",
    r"\bsoriana\b",
    r"\bsoriana\s?(?:h[ií]per|s[uú]per|express)\b",
    r"\bchedraui\b",
    r"\bsuper\s?chedraui\b",
    r"\bselecto\s?chedraui\b",
    r"\bla\s?comer\b",
    r"\bcomercial\s?mexicana\b",
    r"\bfresko\b",
    r"\bcity\s?market\b",
    r"\bsumesa\b",
    r"\bheb\b",
    r"\bh-e-b\b",
    r"\bmi\s?tienda\s?del\s?ahorro\b",
    r"\bs[\s\-]?mart\b",
    r"\bcasaley\b",
    r"\bcasa\s?ley\b",
    r"\bcalimax\b",
    r"\balsuper\b",
    r"\bcostco\b",
    r"\bsam'?s\s?club\b",
    r"\bcity\s?club\b",
    r"\bsuperama\b",
    r"\boxxo\b",
    r"\b7[\s\-]?eleven\b",
    r"\bseven\s?eleven\b",
    r"\btiendas?\s?extra\b",
    r"\bcircle\s?k\b",
    r"\bgomart\b",
    r"\bgo\s?mart\b",
    r"\bkiosko\b",
    r"\bsupercity\b",
    r"\basturiano\b",
    r"\byepas\b",
    r"\bneto\b",
    r"\btiendas?\s?neto\b",
    r"\btiendas?\s?tres\s?b\b",
    r"\btiendas?\s?3b\b",
    r"\bfarmacias?\s?del\s?ahorro\b",
    r"\bfarmacias?\s?guadalajara\b",
    r"\bfarmacias?\s?benavides\b",
    r"\bfarmacias?\s?similares\b",
    r"\bfarmacia\s?san\s?pablo\b",
    r"\bfarmacias?\s?yza\b",
    r"\bfarmacias?\s?roma\b",
    r"\bfarmapronto\b",
    r"\bfarmacias?\s?gi\b",
    r"\bpemex\b",
    r"\boxxo\s?gas\b",
    r"\bpetro[\s\-]?7\b",
    r"\bbp\b",
    r"\bshell\b",
    r"\bchevron\b",
    r"\bgulf\b",
    r"\bg500\b",
    r"\bhidrosina\b",
    r"\brepsol\b",
    r"\btotalenergies\b",
    r"\bsanborns\b",
    r"\bvips\b",
    r"\btoks\b",
    r"\bel\s?port[oó]n\b",
    r"\bla\s?casa\s?de\s?to[ñn]o\b",
    r"\bburger\s?king\b",
    r"\bmc\s?donald'?s?\b",
    r"\bcarl'?s\s?jr\b",
    r"\bkfc\b",
    r"\bkentucky\s?fried\s?chicken\b",
    r"\bsubway\b",
    r"\bdomino'?s\s?pizza\b",
    r"\bpizza\s?hut\b",
    r"\blittle\s?caesars\b",
    r"\bpapa\s?john'?s\b",
    r"\bstarbucks\b",
    r"\bcielito\s?querido\b",
    r"\bitalianni'?s\b",
    r"\bchili'?s\b",
    r"\bapplebee'?s\b",
    r"\bdairy\s?queen\b",
    r"\bnutrisa\b",
    r"\bsanta\s?clara\b",
    r"\bel\s?globo\b",
    r"\bpasteler[ií]as?\s?la\s?esperanza\b",
    r"\bbbva\b",
    r"\bbancomer\b",
    r"\bbanamex\b",
    r"\bcitibanamex\b",
    r"\bsantander\b",
    r"\bbanorte\b",
    r"\bhsbc\b",
    r"\bscotiabank\b",
    r"\binbursa\b",
    r"\bbanco\s?azteca\b",
    r"\bbancoppel\b",
    r"\bcompartamos\s?banco\b",
    r"\bcoppel\b",
    r"\belektra\b",
    r"\bliverpool\b",
    r"\bel\s?palacio\s?de\s?hierro\b",
    r"\bsears\b",
    r"\bsuburbia\b",
    r"\bhome\s?depot\b",
    r"\boffice\s?depot\b",
    r"\bofficemax\b",
    r"\bautozone\b",
    r"\bcin[eé]polis\b",
    r"\bcinemex\b",
    r"\bsmart\s?fit\b",
    r"\bsport\s?city\b",
    r"\btelcel\b",
    r"\bat&t\b",
    r"\bmovistar\b",
    r"\bpepsi\b",
    r"\blaboratorio\b",
    r"\balbergue\b",
    r"\bcentro\s?de\s?salud\b",
    r"\bcl[ií]nica\b",
    r"\bagro",
    r"\bvet",
)

#: Keywords that exclude a place anywhere in its name. Fixed values.
GLOBAL_KEYWORDS = (
    "lotificacion",
    "lotificación",
    "proyecto habitacional",
    "consultorio",
    "clinica dental",
    "laboratorio clinico",
    "taller mecanico",
    "taller automotriz",
    "servicios de mantenimiento",
    "dj ",
    " dj",
    "disc jockey",
    "agencia de viajes",
    "remesas",
    "funeraria",
    "funerales",
    "cancha",
    "futbol",
    "peluqueria",
    "salon de belleza",
    "estetica",
    "mcdonals",
    "burger king",
    "kfc",
    "pizzahut",
    "dominos",
    "mcdonalds",
    "inversiones",
    r"\binv\b",
)

#: Words that protect a place from the blacklist. Fixed values.
KEEP_WORDS = (
    "Abarrotes",
    "Farmacia",
    "Farma",
    "Antojitos",
    "Carniceria",
    "Carnicería",
    "cocina económica",
    "Expendio",
    "Fruta",
    "Frutería",
    "Fruteria",
    "Tienda",
    "Cocina Economica",
    "Cocina económica",
    "Tortillería",
    "Tortilleria",
    "Panaderia",
    "Panadería",
    "Abarroteria",
    "Abarrotería",
    "Restaurante",
    "Restaurant",
    "Bar",
    "Coffee",
    "Café",
    "Cafe",
    "Barra",
    "Barra de Café",
    "Barra de cafe",
    "Barra de café",
    "Asado",
    "Pulperia",
    "PULPERIA",
    "PULPERÍA",
    "Casino",
    "Coffe",
    "Pulp",
    "COMEDOR",
    "Comedor",
    "Bufet",
    "Comidas",
    "Gril",
    "Grill",
    "Grill & Bar",
    "Parrillada",
    "Parrilla",
    "Mini Market",
    "MiniMarket",
    "Bebidas",
    "PUL",
    "Surtidora",
    "Carnitas",
    "Cevicheria",
    "Cevichería",
    "Ceviche",
    "Ceviches",
    "Cocina",
    "Dulcería",
    "La Casa",
    "La casa",
    "Mariscos",
    "Marisquería",
    "Marisqueria",
    "Michelada",
    "Micheladas",
    "Pescados",
    "Miscelánea",
    "Miscelanea",
    "Pizza",
    "Pasteleria",
    "Pastelería",
    "Polleria",
    "Pollería",
    "Hamburguesas",
    "Tacos",
    "Taqueria",
    "Taquería",
    "Tiendita",
    "Tortas",
    "Colmado",
    "Comercial",
    "Bodega",
    "Plaza",
    "AGROVETERINARIA",
    "Provision",
    "Provisions",
    "Provisiones",
    "Comado",
    "Abastecedor",
    "Comida Callejera",
    "Pizzería",
    "Pollos",
    "Pollo",
)

BUILT_IN = {"mx": MX_CHAINS}


def read_pack(path: str | Path) -> list[str]:
    """The entries of a text file, one a line, or of the longest list of strings that a Python file states (which is not run)."""
    raw = Path(path).read_text(encoding="utf-8")
    if Path(path).suffix != ".py":
        return [x for x in raw.splitlines() if x.strip() and not x.startswith("# ")]
    found: list[str] = []
    for node in ast.walk(ast.parse(raw)):
        if isinstance(node, ast.List) and all(isinstance(x, ast.Constant) and isinstance(x.value, str) for x in node.elts) and len(node.elts) > len(found):
            found = [x.value for x in node.elts]
    return found


def pack_file(folder: str | None, name: str) -> Path | None:
    """The folder's file of that name, .txt before .py."""
    return next((p for end in (".txt", ".py") if folder and (p := Path(folder) / f"{name}{end}").exists()), None)


def chain_patterns(country: str, folder: str | None = None) -> list[str]:
    """The chains of a country: from the folder's patterns_<country> (.txt or .py), else built in."""
    own = pack_file(folder, f"patterns_{country.lower()}")
    if own is not None:
        found = read_pack(own)
    elif country.lower() in BUILT_IN:
        found = list(BUILT_IN[country.lower()])
    else:
        raise ValueError(f"no chain patterns for country {country!r}: put patterns_{country.lower()}.txt into the packs folder")
    if not found:
        raise ValueError(f"the chain patterns of {country!r} are empty")
    return found


def blacklist(folder: str | None) -> list[str]:
    """Keywords of the final exclusion, in order, from the folder's blacklist (.txt or .py); without one, module 5 can't run."""
    own = pack_file(folder, "blacklist")
    if own is None:
        raise ValueError("module 5 needs a blacklist: put blacklist.txt into the folder that paths.packs names, or leave the module out")
    return read_pack(own)
