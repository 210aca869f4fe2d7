"""Fixed values of problem 10: the lexicon of abuse by class, and the words of its contexts by concept.

insult: names for a person; degrade: what a group is called; violent: what is done to someone; demean: belittling and
sending away; die: wishes of death; stalk: finding someone; expel: what is to be done with a group; crime: sweeping
accusations; disgust; unworthy; sexual: explicit material; act: explicit scenes.
"""

TERMS = {
    "insult": "idiot|idiots|moron|morons|imbecile|imbeciles|cretin|cretins|dumbass|dumbasses|scumbag|scumbags|lowlife|lowlifes|low life|loser|losers|retard|retards|bastard|bastards|asshole|assholes|bitch|whore|slut|jackass|dipshit|shithead|douchebag|wanker|twat|dickhead|motherfucker|degenerate|halfwit|nitwit|dimwit|simpleton|buffoon|fool|brainless|brainless clown|clown|trash|garbage|piece of trash|piece of garbage|piece of shit|son of a bitch|worthless pig|pig|cockroach|rat|leech|creep|pervert|coward|liar|versager|schwachkopf|vollidiot|idioten|dummkopf|arschloch|trottel|depp|hurensohn|wichser|missgeburt|drecksack|nichtsnutz|vollpfosten|crétin|crétine|abruti|abrutie|connard|connasse|imbécile|débile|salaud|ordure|minable|bouffon|pauvre con|inútil|imbécil|estúpido|estúpida|gilipollas|cabrón|pendejo|subnormal|tonto|payaso|hijo de puta|идиот|идиотка|дурак|дура|придурок|кретин|дебил|урод|тупица|мразь|тварь|ничтожество|сволочь",
    "degrade": "vermin|parasite|parasites|filth|filthy animals|subhuman|subhumans|scum|cockroaches|maggots|savages|plague|disease|infestation|ungeziefer|abschaum|parasiten|untermenschen|dreck|gesindel|schädlinge|vermine|racaille|déchets|cafards|parásitos|parásito|escoria|alimañas|plaga|basura|infrahumanos|паразиты|отребье|мусор|нелюди|быдло",
    "violent": "kill|stab|hurt|beat|beat up|cripple|murder|shoot|strangle|slaughter|rape|smash|choke|break|burn|crush|destroy|umbringen|bringe dich um|bring dich um|töten|abstechen|erschlagen|breche|brechen|tuer|te tuer|frapper|égorger|crever|matar|golpear|apuñalar|romper|убью|убить|зарежу|сломаю",
    "demean": "shut up|get lost|crawl back|under your rock|nobody asked|nobody likes|nobody wants|no one likes|no one wants|would miss|more brains|no brain|no brains|half a brain|ashamed of|ashamed they|so ashamed|waste of space|waste of skin|waste of oxygen|waste of air|worthless|pathetic|type again|keyboard again|go away and|va te faire voir|casse-toi|ferme ta gueule|ta gueule|halt die klappe|halt's maul|verpiss dich|verschwinde|lárgate|cállate|vete a la mierda|заткнись|проваливай|пошёл вон|пошел вон",
    "die": "kill yourself|hang yourself|go die|hope you die|drop dead|deserve to live|deserves to live|better off dead|end your life|end yourself|stop breathing|never breathe|die in a fire|drink bleach|been aborted|jump off|die alone|rot in hell|va mourir|crève|muérete|ojalá te mueras|stirb|häng dich auf|сдохни|чтоб ты сдох|умри|повесься",
    "stalk": "where you live|where you sleep|where you work|to your house|to your home|your home address|find your house|find your home|find your address|find your family|find you|coming for you|come for you|wo du wohnst|deine adresse|dein haus|où tu habites|ton adresse|chez toi|dónde vives|dónde duermes|tu casa|tu dirección|где ты живешь|где ты живёшь|твой адрес|найду тебя|твой дом",
    "expel": "kicked out|thrown out|wiped out|locked up|driven out|rooted out|sent back|shipped back|go back to where|deported|exterminated|eradicated|gassed|get rid of them|do not belong|don't belong|do not need|don't need|ruin everything|ruin our|ruined everything|keep them out|out of our|not human|less than human|rausgeworfen|ausgerottet|abgeschoben|vertrieben|gehören nicht|sobran|expulsados|expulsar|fuera de aquí|expulser|virer|dehors|à chasser|выгнать|выселить|истребить|уничтожить",
    "crime": "thieves|criminals|rapists|terrorists|crooks|animals|rats|dogs|pigs|monkeys|apes|leeches|liars|invaders|diebe|verbrecher|kriminelle|voleurs|criminels|ladrones|criminales|воры|преступники",
    "disgust": "disgusting|disgust me|disgusts me|make me sick|makes me sick|sick of|hate all|hate these|hate those|ekelhaft|widerlich|dégoûtants|dégoûtant|asqueroso|asquerosos|dan asco|противно|ненавижу",
    "unworthy": "do not deserve|don't deserve|doesn't deserve|unworthy|verdienen nicht|verdienst|méritent pas|no merecen|no mereces|не заслуживают|не заслуживаешь",
    "sexual": "porn|porno|pornos|pornography|nudes|xxx|horny|blowjob|orgasm|milf|porn clips|nude pics|nude photos|nude videos|naked pics|sex cams|sex cam|sex clips|sex tape|sex videos|sex chat|xxx videos|porn videos|hot singles|cum|cumshot|handjob|dildo|hentai|nacktbilder|nacktfotos|sexcams|sexchat|filles nues|photos nues|photos porno|vidéos porno|chicas desnudas|fotos desnudas|videos porno|порно|эротика|голые девушки|голые фото",
    "act": "naked body|bare body|her dress|her bra|her panties|her breasts|her thighs|his cock|moaned|moaning|undressed her|stripped naked|kissed her|licked her|thrust into|between her legs|spread her legs|stöhnte|nackten körper|gémissait|corps nu|gemía|cuerpo desnudo|стонала|голое тело",
}
#: Terms of scripts without blanks, and of Korean.
UNSPACED = {
    "insult": "白痴|脑残|蠢货|蠢猪|傻叉|傻逼|傻b|傻瓜|智障|人渣|废物|狗东西|垃圾|贱人|混蛋|王八蛋|畜生|杂种|败类|弱智|二货|蠢驴|死肥猪|狗屎|婊子|脑瘫|沙雕|笨蛋|骗子|馬鹿野郎|クズ|ゴミ人間|能無し|役立たず|ボケ|カス|間抜け|馬鹿|バカ|アホ|무능력자|바보|멍청이|병신|쓰레기|등신|새끼|얼간이",
    "degrade": "寄生虫|蛆虫|祸害|渣滓|害虫|劣等|低等|低等货|下等|下等人|垃圾人种|ゴキブリ|害獣|기생충|벌레|해충",
    "violent": "弄死|砍死|打死|打断腿|打断|杀了你|捅死|整死|掐死|弄残|剁了|揍你|烧了你|殺して|殺すぞ|ぶっ殺|刺して|殴って|죽여|죽일|때려",
    "demean": "没人要|丢人现眼|没脑子|听不懂|怎么做人|赶紧滚|滚开|滚出|滚蛋|闭嘴|浪费粮食|浪费空气|书き込むな|書き込むな|黙れ|失せろ|消えろ|作れないのか|닥쳐|꺼져",
    "die": "去死|跳下去|跳楼|活着就是|不配活|死ね|死んで|自殺しろ|나가 죽어|죽어버려|죽어라",
    "stalk": "找到你|你家在哪|你住在哪|你住哪|上你家|杀你全家|你全家|家を見つけて|家に行って|住所を|너희 집|네 집|찾아갈",
    "expel": "赶出去|赶走|清除出去|消灭|滚回|驱逐|出て行け|出ていけ|追い出せ|追放|쫓아내|추방|몰아내",
    "crime": "小偷|强盗|罪犯|畜牲|泥棒|犯罪者|도둑|범죄자",
    "disgust": "恶心|讨厌死|看不起|気持ち悪い|吐き気|역겨|구역질",
    "unworthy": "不配|没资格|没有一个好|没一个好|資格がない|자격이 없|자격도 없",
    "sexual": "裸聊|无码|色情|成人激情|激情视频|黄片|约炮|一夜情|援交|春药|露骨|裸照|エロ動画|エロ画像|裸の写真|無修正|ヌード写真|援助交際|야동|음란|나체|누드",
    "act": "脱光|裙子里|喘息|香艳|呻吟|裸体|胸部|床上|少妇|服を脱|喘ぎ|抱き合|신음|벗기",
}
#: Parts of the body, and who they belong to where someone is addressed.
BODY = {"en": "legs bones neck face teeth skull fingers knees throat arms head nose", "de": "knochen beine zähne fresse nase hals finger", "fr": "jambes os dents gueule cou doigts", "es": "piernas huesos dientes cara cuello dedos", "ru": "ноги кости зубы руки шею"}
POSSESSIVES = {"en": "your|ur", "de": "deine|dir die|dir den|dein", "fr": "tes|te casser les|ton", "es": "tus|tu|las|los", "ru": "тебе|твои|твою"}
#: The contexts by concept.
CONTEXTS = {
    "you": "you|your|yours|you're|youre|u r|yourself|du|dich|dir|dein|deine|euch|ihr seid|tu|te|toi|ton|vous|t'es|eres|tú|ti|usted|ustedes|te voy|ты|тебя|тебе|твой|твою|вы|вас|你|您|你们|お前|おまえ|てめえ|貴様|あんた|너|넌|당신|네가|니가|너희",
    "maker": "whoever|the author|this author|the maintainer|the maintainers|this maintainer|the admin|the moderator|the developer|this guy|that guy|op is|the op|the poster|would ship|would write|wrote this|made this|built this|wer das|celui qui|el que hizo|кто это|楼主|客服|作者|写这个|的人真是|这种人|この野郎|作者は|글쓴이|개발자",
    "name": "you are a|you are an|you are such|you are nothing|you're a|you're an|you're such|such a|only a|only an|nothing but a|du bist|ihr seid|tu es|t'es|vous êtes|espèce de|eres un|eres una|ты просто|ты такой|你就是|你是|你这|真是|全是|お前は|この|너는|너는 정말",
    "group": "foreigners|immigrants|migrants|refugees|women|men|gays|jews|muslims|christians|hindus|blacks|whites|asians|gypsies|old people|young people|disabled people|poor people|fat people|natives|northerners|southerners|ausländer|flüchtlinge|frauen|juden|muslime|étrangers|immigrés|femmes|juifs|musulmans|extranjeros|inmigrantes|mujeres|migrantes|judíos|иностранцы|мигранты|женщины|евреи|外国人|外地人|乡下人|女人|移民|外人|外国の|女は|외국인|여자들|이민자",
    "every": "all|every|every one|they are|they're|them all|the lot|the lot of them|by nature|always|those people|these people|alle|sind|tous|toutes|sont|todos|todas|son|все|они|都是|都|全部|全是|天生|一个个|就|みんな|全員|모두|전부|다",
    "should": "should|must|have to|ought|deserve|need to be|gehören|müssen|sollten|doivent|devraient|deben|deberían|надо|должны|应该|必须|べき|해야",
    "threat": "i will|i'll|i am going to|i'm going to|gonna|we will|going to|i know|watch your back|just wait|ich werde|ich weiß|ich finde|und breche|je vais|je sais|je trouverai|voy a|sé dónde|encontraré|я тебя|я знаю|найду|信不信|再敢|我就|我要|我会|小心|つもりだ|やる|やるぞ|할 거야|버릴",
    "offer": "free|for free|send|send me|message me|dm me|text me|every night|channel|my channel|link|the link|waiting|hot|girls|cheap|subscribe|tonight|gratis|gratuites|gratuit|kanal|schick|écris|écris-moi|envoie|escríbeme|envía|manda|heiße|бесплатно|напиши|пришли|免费|私信|加我|链接|好友|领取|资源|有没有|越|寂寞|求|看得人|見放題|送ります|送って|無料|무료|보내",
    "scene": "he|she|her|his|him|while|slowly|bed|lips|skin|er|sie|elle|il|ella|él|она|он|她|他|床|唇|手伸|画面|场面|彼女|彼は|그녀|침대",
    "list": "word|words|word list|wordlist|words like|such as|list|lists|blocks|blocked|block|blocklist|blacklist|denylist|moderation|moderator tool|profanity|filter|filters|filtered|banned|term|terms|regex|detects|detect|classifier|label|labels|flagged|flags|category|wortliste|sperrt|begriffe|begriff|mots|liste|interdits|bloqués|palabras|lista|bloquea|término|список|слов|слова|фильтр|词|词表|词库|敏感词|屏蔽|过滤|拦截|命中|等词|禁止語|ブロック|単語|リスト|금지어|차단|목록|단어",
    "report": "called me|he said|she said|they said|wrote to us|reported|quote|quoted|example of|complaint|complained|was told|said that|nannte mich|m'a traité|me llamó|назвал меня|骂我|说我|举报|投诉|引用|と言われ|라고 했",
    "tech": "process|processes|thread|threads|worker|daemon|signal|task|child|children|server|job|container|zombie|orphan|master|slave|garbage collector|collection|collect|memory|cache|cookies|branch|debug|symbols|field|value|values|gender|male|female|color|colour|theme|tones|tone|portrait|video editor|trailer|scene|mode|layout|wizard|test|build|code|loop|button|header|dependency|function|object|objects|api|event|prozess|processus|proceso|процесс|进程|线程|任务|性别|主题|配色|裸机|裸眼|接口|向导|垃圾分类|垃圾回收|傻瓜式|小程序|プロセス|スレッド|프로세스",
    "proof": "proof|proofed|傻瓜式",
    "software": "this api is|the api is|api is|the manual|documentation|docs|the sdk|sdk is|library is|framework is|compiler|the bug|this bug|the app|this app|software|the layout|the build|die api|la api|l'api|接口真|文档|这个接口|这个框架|ドキュメント|문서",
    "teach": "health|clinic|medical|cancer|breast cancer|biology|anatomy|reproductive|reproduction|education|course|courses|lesson|learners|school|students|screening|gesundheit|santé|salud|здоровье|健康|医学|教育|课程|生理|保健|健診|教育の|건강|교육",
    "art": "movie|film|novel|song|lyrics|the game|in level|boss|npc|电影|小说|歌词|游戏|角色|映画|ゲーム|영화|게임",
}
#: Words an edit or a sign away from a term that are no disguise of it.
HARMLESS = frozenset("regard record reward retry animal woman parasitic fester fasten filter fifth nudge closer lower loose loses lost user users tool tools food foot salad master inutile inutil trust tresh crash brash breaks breaking breakdown beats heart hurts sexes text next dude dick's boring boringly looser sloser leaser lasers laser closers creep-in bust busts shirt shirts witch batch pitch ditch burns bitten switch moan broken smashed garbages crushed destroyed destroys destroyer killed kills killing killer murdered shot shooting raped hurting beaten beating cowards".split())
