"""The bundled grammars of the syntax check, as plain rules, and the LL(1) tables made from them.

A rule is ``name: alternative | alternative``; a symbol that no rule names is a token kind, ``~`` is the
empty alternative, and of two alternatives that begin with the same token the first one holds.  ``SEMI``
is the statement end, which the parser decides itself.  Operators have no precedence here: a table that
only says whether a text is valid does not need one.
"""

from __future__ import annotations

#: ArkTS, TypeScript and plain script.  ``A(`` opens arrow parameters, ``aid`` is a lone arrow parameter,
#: ``T<`` and ``T>`` enclose type arguments, ``C<`` and ``C>`` the type of an assertion, ``U{`` opens the child block of a UI component (or a method body),
#: ``mname`` is the name of a method outside a class, ``mod`` a modifier: syntax.py marks these.
SCRIPT = """
program: item program | ~
item: import importrest | export exportrest | @ deco decorated | mod modrest | mname callsig fbody | stmt
decorated: @ deco decorated | export exportrest | mod modrest | mname callsig fbody | function fnrest | classword classrest | class classrest | nsword nsrest
modrest: mod modrest | mname callsig fbody | function fnrest | class classrest | classword classrest | const constrest | let declrest SEMI | var declrest SEMI | typeword typerest | nsword nsrest | enum enumrest | @ deco modrest
deco: name decotail
decotail: . name decotail | ( args ) | ~
importrest: str SEMI | lazyword importclause fromword str SEMI | importclause importend
importend: fromword str SEMI | = expr SEMI
importclause: id importmore | { specs } | * asword id
importmore: , importmore2 | ~
importmore2: { specs } | * asword id
specs: spec specsrest | ~
specsrest: , specs | ~
spec: specname
specname: name specas | default specas
specas: asword specto | ~
specto: name | default
exportrest: default exportdefault | { specs } exportfrom | * exportstar fromword str SEMI | @ deco exportdeco | mod modrest | function fnrest | class classrest | classword classrest | enum enumrest | const constrest | let declrest SEMI | var declrest SEMI | typeword typerest | nsword nsrest | async function fnrest | = expr SEMI | import importrest
exportdeco: @ deco exportdeco | class classrest | classword classrest | function fnrest | mod modrest
exportstar: asword id | ~
exportfrom: fromword str SEMI | SEMI
exportdefault: function fnrest | class classrest | classword classrest | @ deco exportdeco | async asyncrest tail binrest SEMI | mod modrest | assign SEMI
stmts: stmt stmts | ~
stmt: { stmts } | ; | const constrest | let declrest SEMI | var declrest SEMI | if ( expr ) stmt elseopt | for forawait ( forhead ) stmt | while ( expr ) stmt | do stmt while ( expr ) semiopt | return expropt SEMI | break idopt SEMI | continue idopt SEMI | throw expr SEMI | try { stmts } tryrest | switch ( expr ) { cases } | function fnrest | class classrest | classword classrest | label : stmt | enum enumrest | typeword typerest | nsword nsrest | debugger SEMI | . name tail SEMI | async asyncstmt | @ deco stmtdeco | expr SEMI
stmtdeco: @ deco stmtdeco | function fnrest | class classrest | classword classrest
asyncstmt: function fnrest | aid => abody binrest SEMI | A( params ) rtype => abody binrest SEMI | mname callsig fbody
importexpr: ( args ) | . name
constrest: enum enumrest | declrest SEMI
semiopt: ; | ~
elseopt: else stmt | ~
forawait: await | ~
forhead: const binding typeann forinit | let binding typeann forinit | var binding typeann forinit | ; expropt ; expropt | expr forexpr
forinit: ofword expr | in expr | init declmore ; expropt ; expropt
forexpr: ofword expr | ; expropt ; expropt
idopt: id | ~
tryrest: catch catchvar { stmts } finallyopt | finally { stmts }
catchvar: ( binding typeann ) | ~
finallyopt: finally { stmts } | ~
cases: case expr : stmts cases | default : stmts cases | ~
declrest: binding bang typeann init declmore
bang: postbang | ~
declmore: , binding bang typeann init declmore | ~
binding: id | mname | { bindprops } | [ bindelems ]
bindprops: bindprop bindpropsrest | ~
bindpropsrest: , bindprops | ~
bindprop: ... binding | propname bindvalue
bindvalue: : binding init | init
bindelems: , bindelems | binding init bindelemsrest | ... binding | ~
bindelemsrest: , bindelems | ~
init: = assign | ~
typeann: : type | ~
expropt: expr | ~
expr: assign commas
commas: , assign commas | ~
assign: aid => abody | A( params ) rtype => abody | async asyncrest tail binrest | yield yieldrest | T< typeparams T> A( params ) rtype => abody | unary binrest
yieldrest: * assign | expropt
asyncrest: function fnrest | aid => abody | A( params ) rtype => abody | ( args )
abody: { stmts } | U{ stmts } | assign
binrest: binop assign | > gtrest | ? assign : assign | asword type binrest | asgn assign | ~
binop: + | - | * | / | % | ** | == | != | === | !== | < | <= | >= | && | || | ?? | & | bar | ^ | << | instanceof | in
asgn: = | += | -= | *= | /= | %= | **= | <<= | &= | |= | ^= | &&= | ||= | ??=
unop: ! | tilde | + | - | ++ | -- | typeof | void | delete | await | new
gtrest: > gtrest2 | asgn assign | assign
gtrest2: > gtrest3 | asgn assign | assign
gtrest3: asgn assign | assign
unary: unop unary | C< type C> unary | postfix
postfix: primary tail
tail: . name tail | ?. optafter tail | [ expr ] tail | ( args ) tail | T< typeargs T> taft tail | template tail | postinc tail | postbang tail | U{ stmts } tail | ~
taft: ( args ) | ~
optafter: [ expr ] | ( args ) | name
template: tpl | th expr tplrest
tplrest: tm expr tplrest | tt
primary: id | mname | num | str | template | rx | this | super | null | true | false | ( expr ) | [ elems ] | { props } | function fnrest | class classrest | importx importexpr
elems: , elems | elem elemsrest | ~
elemsrest: , elems | ~
elem: ... assign | assign
args: arg argsrest | ~
argsrest: , args | ~
arg: ... assign | assign
props: prop propsrest | ~
propsrest: , props | ~
prop: ... assign | acc propname propval | async starprop propname callsig fbody | * propname callsig fbody | propname propval | . name tail chainprops
chainprops: . name tail chainprops | ~
starprop: * | ~
propval: : assign | = assign | callsig fbody | ~
propname: name | str | num | [ expr ]
name: id | mname | aid
fnrest: starprop fname callsig fbodyopt
fname: id | mname | ~
callsig: tparams ( params ) rtype
fbody: { stmts } | U{ stmts }
fbodyopt: { stmts } | U{ stmts } | SEMI
tparams: < typeparams > | T< typeparams T> | ~
typeparams: typeparam typeparamsrest | ~
typeparamsrest: , typeparams | ~
typeparam: id tpext tpdef
tpext: extends type | ~
tpdef: = type | ~
params: param paramsrest | ~
paramsrest: , params | ~
param: @ deco param | mod param | ... binding typeann | this typeann | binding opt typeann init
opt: ? | ~
rtype: : type | ~
type: typeone typeops
typeops: bar typeone typeops | & typeone typeops | isword typeone typeops | extends typeone ? type : type | ~
typeone: bar typeone | typeunary
typeunary: keyofword typeunary | typeof typename typetail | typeprim typetail
typeprim: typename targs | str | num | - num | tpl | null | true | false | void | this | { members } | U{ members } | [ typelist ] | ( type ) | A( params ) => type | new A( params ) => type | import ( str ) . typename targs | T< typeparams T> A( params ) => type
typename: id typenamerest | mname typenamerest
typenamerest: . name typenamerest | ~
targs: < typelist > | T< typelist T> | ~
typeargs: typelist
typelist: typeitem typelistrest | ~
typelistrest: , typelist | ~
typeitem: ... type | type typeitemrest
typeitemrest: ? typeann | : type | ~
typetail: [ typeidx ] typetail | ~
typeidx: type | ~
members: member membersep | ~
membersep: ; members | , members | members
member: [ idxsig ] memberval | mod member | acc member | new callsig | ( params ) rtype | < typeparams > ( params ) rtype | propname2 memberval
propname2: name | str | num
idxsig: id idxrest | expr
idxrest: : type | in type | tail binrest
memberval: opt2 memberrest
opt2: ? | postbang | ~
memberrest: callsig | : type | ~
classrest: classname tparams heritage { classbody }
classname: id | mname | ~
heritage: extends postfix_type heritagemore | implementsword typelist2 heritage | ~
heritagemore: , typelist2 heritage | heritage
postfix_type: typename targs exttail
exttail: ( args ) exttail | ~
typelist2: type typelist2rest
typelist2rest: , type typelist2rest | ~
classbody: ; classbody | @ deco classbody | cmember classbody | ~
cmember: mod cmember2 | cmember2plain
cmember2: mod cmember2 | { stmts } | U{ stmts } | @ deco cmember2 | cmember2plain
cmember2plain: acc memname callsig fbodyopt | async asyncmem | * memname callsig fbody | memname memrest
asyncmem: * memname callsig fbodyopt | memname callsig fbodyopt
memname: name | str | num | [ idxsig ]
memrest: opt3 memrest2
opt3: ? | postbang | ~
memrest2: ( params ) rtype fbodyopt | < typeparams > ( params ) rtype fbodyopt | T< typeparams T> ( params ) rtype fbodyopt | typeann init SEMI
enumrest: name { enumbody }
enumbody: enummem enumrest2 | ~
enumrest2: , enumbody | ~
enummem: propname init
typerest: id tparams = type SEMI
nsrest: nsname { nsbody }
nsname: id nsdots | str
nsdots: . id nsdots | ~
nsbody: item nsbody | ~
"""

#: Java. ``decl`` stands before a type that begins a declaration, ``cast(`` opens a cast, ``L(`` lambda
#: parameters, ``lid`` is a lone lambda parameter, ``yieldword`` gives a switch its value, ``T<``/``T>`` type arguments, ``mname`` a method or constructor name.
JAVA = """
program: item program | ~
item: package qname ; | import staticopt qname importstar ; | decoratedj
staticopt: static | ~
importstar: . * | ~
qname: id qrest
qrest: . id qrest | ~
decoratedj: mods declj | ;
mods: modj mods | ann mods | ~
modj: public | private | protected | static | final | abstract | native | synchronized | transient | volatile | strictfp | default
ann: @ qname annargs
annargs: ( annlist ) | ~
annlist: annitem annlistrest | ~
annlistrest: , annlist | ~
annitem: kid = annval | annval
annval: { annvals } | ann | expr
annvals: annval annvalsrest | ~
annvalsrest: , annvals | ~
declj: class typedecl | interface typedecl | enum enumdecl | @ interface id { body } | typarams declafter | { stmts }
declafter: mname ( params ) throwsj bodyj | decl type declname | void mname ( params ) dims throwsj bodyj
declname: mname ( params ) dims throwsj bodyj | id dims initj declsj ;
declsj: , id dims initj declsj | ~
initj: = initval | ~
initval: { arrvals } | expr
arrvals: initval arrvalsrest | ~
arrvalsrest: , arrvals | ~
throwsj: throws typelistj | ~
typelistj: type typelistjrest
typelistjrest: , type typelistjrest | ~
bodyj: { stmts } | ; | default annval ;
typedecl: id typarams heritagej { body }
heritagej: extends typelistj heritagej | implements typelistj heritagej | ~
body: member body | ~
member: mods declj | ;
enumdecl: id heritagej { enumconsts enumtail }
enumconsts: mods id enumargs enumbody enumconstsrest | mods mname enumargs enumbody enumconstsrest | ~
enumargs: ( args ) | ~
enumbody: { body } | ~
enumconstsrest: , enumconsts | ~
enumtail: ; body | ~
typarams: T< typaramlist T> | < typaramlist > | ~
typaramlist: id typbound typaramsrest
typaramsrest: , typaramlist | ~
typbound: extends type typboundmore | ~
typboundmore: & type typboundmore | ~
params: param paramsrest | ~
paramsrest: , param paramsrest | ~
param: pmods type ellipsis pname dims
pname: id | this
pmods: final pmods | ann pmods | decl | ~
ellipsis: ... | ~
type: prim dims | qtype dims
prim: boolean | byte | char | short | int | long | float | double
qtype: id targs qtyperest
qtyperest: . id targs qtyperest | ~
targs: T< targlist T> | < targlist > | ~
targlist: targ targlistrest | ~
targlistrest: , targlist | ~
targ: ? wild | ann targ | type
wild: extends type | super type | ~
dims: [ ] dims | ~
stmts: stmt stmts | ~
stmt: { stmts } | ; | localmods | if ( expr ) stmt elseopt | for ( forhead ) stmt | while ( expr ) stmt | do stmt while ( expr ) ; | return expropt ; | break idopt ; | continue idopt ; | throw expr ; | try tryres { stmts } catches | switch ( expr ) { cases } | yieldword expr ; | synchronized ( expr ) { stmts } | assert expr assertmsg ; | label : stmt | class typedecl | interface typedecl | enum enumdecl | expr ;
localmods: final localdecl | ann localdecl | static localdecl | abstract localdecl | decl type id dims initj declsj ;
localdecl: final localdecl | ann localdecl | abstract localdecl | class typedecl | decl type id dims initj declsj ;
elseopt: else stmt | ~
forhead: final forhead | ann forhead | decl type id dims fordecl | ; expropt ; exprlist | expr moreexprs ; expropt ; exprlist
fordecl: : expr | initj declsj ; expropt ; exprlist
exprlist: expr moreexprs | ~
moreexprs: , expr moreexprs | ~
idopt: id | ~
expropt: expr | ~
assertmsg: : expr | ~
tryres: ( resources ) | ~
resources: resource resourcesrest
resourcesrest: ; resourcesrest2 | ~
resourcesrest2: resource resourcesrest | ~
resource: final resource | decl type id = expr | expr
catches: catch ( catchparam ) { stmts } catches | finally { stmts } | ~
catchparam: pmods type catchmore id
catchmore: bar type catchmore | ~
cases: case caselabels casearrow cases | default casearrow cases | ~
caselabels: expr caselabelsrest
caselabelsrest: , expr caselabelsrest | ~
casearrow: : stmts | -> arrowbody
arrowbody: { stmts } | throw expr ; | expr ;
expr: lid -> lbody | L( lparams ) -> lbody | unary binrest
lbody: { stmts } | expr
lparams: lparam lparamsrest | ~
lparamsrest: , lparam lparamsrest | ~
lparam: decl type id | final lparam | lpid
lpid: id | lid
binrest: binop expr | > gtrest | ? expr : expr | instanceof finalopt type idopt2 binrest | asgn expr | ~
binop: + | - | * | / | % | == | != | < | <= | >= | && | || | & | bar | ^ | <<
asgn: = | += | -= | *= | /= | %= | <<= | &= | |= | ^=
unop: ! | tilde | + | - | ++ | --
finalopt: final | ~
idopt2: id | ~
gtrest: > gtrest2 | asgn expr | expr
gtrest2: > gtrest3 | asgn expr | expr
gtrest3: asgn expr | expr
unary: unop unary | cast( type castmore ) castee | postfix
castmore: & type castmore | ~
castee: lid -> lbody | L( lparams ) -> lbody | unary
postfix: primary tail
tail: . dotname tail | [ idx ] tail | ( args ) tail | :: refname tail | postinc tail | T< targlist T> tail | ~
idx: expr | ~
dotname: id | mname | kid | this | super | class | new newbody | T< targlist T> id
refname: id | mname | new
primary: id | mname | kid | num | str | this | super | null | true | false | ( expr ) | new newbody | prim dims primtail | void . class | switch ( expr ) { cases }
primtail: . class | :: new
newbody: ann newbody | newtype newafter
newtype: prim | id targs qtyperest | mname targs qtyperest
newafter: ( args ) anonbody | [ idx ] newdims arrinit | ~
newdims: [ idx ] newdims | ~
arrinit: { arrvals } | ~
anonbody: { body } | ~
args: expr argsrest | ~
argsrest: , expr argsrest | ~
"""


def tables(grammar: str) -> dict[str, dict[str | None, tuple[str, ...]]]:
    """For each rule the right side (reversed, for a stack) by the next token; under None what holds for any other.

    Only a rule that may be empty, or may be a mere statement end, has None; an error then shows at the next token.
    """
    rules: dict[str, list[list[str]]] = {}
    for line in grammar.strip().splitlines():
        name, _, right = line.partition(": ")
        rules[name] = [[s for s in one.split() if s != "~"] for one in right.split(" | ")]
    empty: set[str] = {"SEMI"}
    ends: set[str] = {"SEMI"}
    first: dict[str, set[str]] = {name: set() for name in rules} | {"SEMI": {";"}}
    changed = True
    while changed:
        changed = False
        for name, alternatives in rules.items():
            for alternative in alternatives:
                for symbol in alternative:
                    found = first[symbol] if symbol in first else {symbol}
                    if not found <= first[name]:
                        first[name] |= found
                        changed = True
                    if symbol not in empty:
                        break
                else:
                    if name not in empty:
                        empty.add(name)
                        changed = True
                    if name not in ends and any(s in ends for s in alternative):
                        ends.add(name)
                        changed = True
    table: dict[str, dict[str | None, tuple[str, ...]]] = {}
    for name, alternatives in rules.items():
        row = table[name] = {}
        for alternative in alternatives:
            for symbol in alternative:
                for key in first.get(symbol, {symbol}):
                    row.setdefault(key, tuple(reversed(alternative)))
                if symbol not in empty:
                    break
            else:
                row.setdefault(None, tuple(reversed(alternative)) if any(s in ends for s in alternative) else ())
    return table
